"""Versioned tables: each run writes its rows once, into a folder of its own, and a manifest says which run holds
which slice.

A slice is a (date_key, country_code) of a table.  ``root/<table>/run=<run>/month=../`` holds a run's rows of a month;
``root/_manifest/version=<n>/`` has one row for each slice that version ``n`` puts in place or takes away.  A slice's rows
are those of the run that the last version with that slice names.  A version is one file, written after all
tables' rows are: until it is there, readers see the version before, so all tables swap at once, and slices that
a run doesn't name stay as they were.

Nothing is copied and nothing is deleted by a publish.  ``vacuum`` writes the manifest's present state as one version and
removes folders that no slice names.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix import session

SLICE = ["date_key", "country_code"]
MANIFEST = "table string, date_key date, country_code string, run string, rows long"
_PLACE = [T.StructField("run", T.StringType()), T.StructField("month", T.StringType())]
#: Slices that a reader broadcasts to pick rows (60 bytes each); beyond, rows and slices meet in a sort-merge join.
BROADCAST_SLICES = 200_000


def new_run() -> str:
    return "r" + uuid.uuid4().hex[:12]  # a letter first: partition values that look like numbers would become numbers


def matching(left: DataFrame, right: DataFrame, on: list[str] | None = None, how: str = "left_semi") -> DataFrame:
    """Rows of ``left`` that have (or by ``left_anti`` lack) an equal row in ``right``, nulls alike; on the slice by default."""
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on or SLICE]
    return left.alias("l").join(right.alias("r"), reduce(lambda x, y: x & y, same), how)


class Store:
    """The versioned tables under a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = session.configure(spark), root.rstrip("/")

    def path(self, table: str, run: str | None = None) -> str:
        return f"{self.root}/{table}" + (f"/run={run}" if run else "")

    # --- writing ---------------------------------------------------------------------------------

    def write(self, table: str, run: str, df: DataFrame) -> DataFrame:
        """A run's rows of a table, written once, and read back.  They aren't published by this.

        Rows are gathered by month (a large one is split among tasks) and sorted by slice, so that files are few and a reader
        of some days or countries skips the others' row groups."""
        month = F.coalesce(F.date_format("date_key", "yyyy-MM"), F.lit("none")).alias("month")
        (df.select("*", month).hint("rebalance", "month").sortWithinPartitions("month", *SLICE).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("month").parquet(self.path(table, run)))
        if not self.has(table):
            session.write_text(self.spark, f"{self.path(table)}/_schema.json", df.schema.json())
        return self.spark.read.schema(df.schema).parquet(self.path(table, run)).select(*df.columns)

    def slices(self, table: str, written: DataFrame) -> DataFrame:
        """(table, date_key, country_code, rows) of what a run has written."""
        return written.groupBy(*SLICE).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), *SLICE, "rows")

    def commit(self, entries: DataFrame) -> int:
        """Publish a version: ``entries`` has the columns of ``MANIFEST``, a null run takes a slice away.  Returns the version.

        One task writes one file, whose rename is the swap.  A version that another publisher has just written raises."""
        version = self.version() + 1
        (entries.select("table", *SLICE, "run", "rows").repartition(1).sortWithinPartitions("table", *SLICE)
         .write.mode("error").parquet(f"{self.root}/_manifest/version={version}"))
        return version

    # --- reading ---------------------------------------------------------------------------------

    def manifest(self) -> DataFrame:
        schema = MANIFEST + ", version long"
        if not session.exists(self.spark, f"{self.root}/_manifest"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/_manifest")

    def versions(self) -> list[int]:
        """Versions that were begun; one that names nothing, or was never finished, counts too."""
        names = [f.rpartition("/")[2] for f in session.children(self.spark, f"{self.root}/_manifest")]
        return [int(n.partition("=")[2]) for n in names if n.startswith("version=")]

    def version(self) -> int:
        """The last version, 0 before the first."""
        return max(self.versions(), default=0)

    def has(self, table: str) -> bool:
        """Whether a run ever wrote the table."""
        return session.exists(self.spark, f"{self.path(table)}/_schema.json")

    def runs(self) -> set[str]:
        """Runs that a version has named (a row per run)."""
        return {r.run for r in self.manifest().where("run is not null").select("run").distinct().collect()}

    def current(self, table: str | None = None, version: int | None = None) -> DataFrame:
        """(table, date_key, country_code, run, rows): the slices in place, as of a version."""
        rows = self.manifest()
        if table is not None:
            rows = rows.where(F.col("table") == table)
        if version is not None:
            rows = rows.where(F.col("version") <= version)
        last = rows.groupBy("table", *SLICE).agg(F.max(F.struct("version", "run", "rows")).alias("last"))
        return last.select("table", *SLICE, "last.run", "last.rows").where("run is not null")

    def read(self, table: str, version: int | None = None, within=None) -> DataFrame:
        """A table's rows, as its first run's schema has them.  ``within`` narrows a DataFrame with the slice's columns: it is
        applied to slices and to rows, so files of other days aren't read.  A table that no run wrote raises."""
        narrow = within or (lambda df: df)
        found = narrow(self.current(table, version))
        month = F.coalesce(F.date_format("date_key", "yyyy-MM"), F.lit("none")).alias("month")
        places = found.groupBy("run", month).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per run and month of it
        schema = T.StructType.fromJson(json.loads(session.read_text(self.spark, f"{self.path(table)}/_schema.json")))
        if not places:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path(table, r.run)}/month={r.month}" for r in places]
        rows = narrow(self.spark.read.schema(T.StructType([*schema.fields, *_PLACE])).option("basePath", self.path(table))
                      .parquet(*paths))
        found = found.select("run", *SLICE)
        found = F.broadcast(found) if sum(r.n for r in places) <= BROADCAST_SLICES else found.hint("merge")
        return matching(rows, found, ["run", *SLICE]).select(*schema.names)

    # --- upkeep ----------------------------------------------------------------------------------

    def vacuum(self) -> int:
        """One version with the present state, and nothing of earlier ones; folders of runs that it doesn't name go.  Earlier
        versions can't be read any more.  Not to be run beside a publish.  Returns the number of folders removed."""
        state = session.materialize(self.current(), "manifest")
        keep = {(r.table, r.run) for r in state.select("table", "run").distinct().collect()}  # a row per table and run
        before = self.versions()
        self.commit(state)
        for v in before:
            session.delete(self.spark, f"{self.root}/_manifest/version={v}")
        gone = 0
        for folder in session.children(self.spark, self.root):
            table = folder.rpartition("/")[2]
            for run in session.children(self.spark, folder):
                name = run.rpartition("run=")[2]
                if "/run=" in run and (table, name) not in keep:
                    session.delete(self.spark, run)
                    gone += 1
        return gone
