"""Helpers shared by the text operators: reading, batch sizes, row keys, distributed prefix sums, components."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmix.session import configure, materialize

__all__ = ["configure", "materialize"]

#: Rows per Arrow batch on paths that carry whole texts (a few MB even where documents are long).
TEXT_BATCH_ROWS = 256
#: Rows per Arrow batch on paths that carry narrow rows only.
NARROW_BATCH_ROWS = 65536
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: What the contracts call white space; a word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
#: Parts into which the rows of one key are dealt where a key may hold a large share of them.
SALTS = 16


def prepare(spark: SparkSession) -> None:
    """Session settings of the library, and small Arrow batches for texts."""
    configure(spark)
    spark.conf.set(ARROW_ROWS, str(TEXT_BATCH_ROWS))


@contextmanager
def narrow_batches(spark: SparkSession):
    """Large Arrow batches for the action inside (rows of a few numbers each)."""
    spark.conf.set(ARROW_ROWS, str(NARROW_BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, str(TEXT_BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; -1 for a null id."""
    return F.coalesce(F.crc32(column.cast("string")) % m, F.lit(-1)).cast("int")


def row_key(doc_id: Column, text: Column) -> Column:
    """A string that identifies a document: its id with a digest of its text, as ids may be null or repeat."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit(""))))


def numbered(df: DataFrame, key: str, out: str) -> DataFrame:
    """Number the rows that share a key from 0 (all 0, without a shuffle, where no key repeats)."""
    repeated = df.groupBy(key).count().filter("count > 1").limit(1).count() > 0
    if not repeated:
        return df.withColumn(out, F.lit(0))
    rest = [c for c in df.columns if c != key]
    order = F.xxhash64(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0)
    return df.withColumn(out, F.row_number().over(W.partitionBy(key).orderBy(order)) - 1)


def prefix_sums(df: DataFrame, group: list[str], order: list, value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` in each group's ``order``, with no group in one task.

    Rows are dealt out by range of (group, order), so a large group lies in many partitions.  Sums of
    partitions give each one's offset (one row per partition and group in it); the rest of the sum is taken
    inside the partition.  ``order`` must be a total order up to identical rows.  Sums of longs are exact,
    so the result doesn't depend on how rows were dealt.
    """
    spark = df.sparkSession
    keys = [F.col(c) for c in group] + list(order)
    dealt = (df.repartitionByRange(partitions(spark), *keys).withColumn("part_", F.spark_partition_id()))
    dealt = materialize(dealt, "prefix")
    sums = dealt.groupBy(*group, "part_").agg(F.sum(value).alias("sum_"))
    before = W.partitionBy(*group).orderBy("part_").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*group, "part_", F.coalesce(F.sum("sum_").over(before), F.lit(0)).alias("offset_"))
    inside = W.partitionBy(*group, "part_").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (dealt.withColumn("inside_", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(offsets, [*group, "part_"])
            .withColumn(out, F.col("offset_") + F.col("inside_"))
            .drop("part_", "inside_", "offset_"))


def dealt_join(rows: DataFrame, per_key: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """Join with a table of one row per key, a key's rows dealt over SALTS tasks by another column's hash."""
    salt = F.pmod(F.xxhash64(F.col(f"`{by}`")), F.lit(SALTS)).cast("int")
    dealt = per_key.withColumn("llm_salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.withColumn("llm_salt_", salt).join(dealt.hint("merge"), [key, "llm_salt_"], how)  # grows with the data
    return joined.drop("llm_salt_")


def _to_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the least neighbour of u."""
    return dealt_join(pairs, pairs.groupBy("u").agg(F.min("v").alias("m")), "u", "v")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node that can be reached.

    Alternates large-star and small-star steps.  Each round's links are written to the shared checkpoint
    folder, so lineage stays short and a lost executor costs one round at most.  The driver sees two numbers
    per round.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "links")

    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = state(edges)
    while now[0]:
        both = edges.selectExpr("a as u", "b as v").unionByName(edges.selectExpr("b as u", "a as v"))
        large = (_to_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
                 .distinct())
        joined = _to_least(large)
        small = joined.selectExpr("v as a", "m as b").unionByName(joined.selectExpr("u as a", "m as b"))
        edges = materialize(small.filter("a <> b").distinct(), "links")
        before, now = now, state(edges)
        if now == before:
            break
    roots = edges.selectExpr("a as node", "b as root")
    return roots.unionByName(edges.selectExpr("b as node", "b as root").distinct())
