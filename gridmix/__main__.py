"""Command line for scheduled runs (``spark-submit -m gridmix ...`` or ``python -m gridmix``).

  daily    INPUT --silver PATH --warehouse PATH --date YYYY-MM-DD [--countries DE,FR] [--gate all|keys]
  backfill INPUT --silver PATH --warehouse PATH --start D --end D [--countries ALL] [--gate all|keys]
           both also: [--on-failure stop|hold] [--only-changed]
  vacuum   --warehouse PATH                  (one manifest version, and only the folders that it names)
  query    NAME --sf DIR --out PATH          (write one named query's result as Parquet)
  list                                       (names of the registered queries)

INPUT is ``--bronze PATH`` (a folder with ``documents`` and ``cubes``, see plans/increments.py), or ``--raw PATH``:
generation rows in the silver layout (epoch-ns ``timestamp``, country, energy_source, psr_type, actual_MW,
forecast_MW, domain).  One run covers every requested country; a re-run replaces the slices that its input covers.
The gate looks at all declared error tests, or with ``--gate keys`` at key integrity alone.  A failure stops the run, or
with ``--on-failure hold`` keeps back the slices (day, country) that fail, with their reasons in ``held_back``.  With
``--only-changed`` documents and cubes that the last published run has read are left alone (``--bronze`` only).
Published tables are read with ``plans.increments.published``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from gridmix import session

    spark = SparkSession.builder.appName("gridmix").getOrCreate()
    return session.configure(spark)


def _countries(value: str):
    return "ALL" if value.upper() == "ALL" else [c.strip() for c in value.split(",") if c.strip()]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="gridmix")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("daily", "backfill"):
        p = sub.add_parser(name)
        source = p.add_mutually_exclusive_group(required=True)
        source.add_argument("--raw")
        source.add_argument("--bronze")
        p.add_argument("--gate", choices=["all", "keys"], default="all")
        p.add_argument("--silver", required=True)
        p.add_argument("--warehouse", required=True)
        p.add_argument("--countries", default="ALL")
        p.add_argument("--on-failure", choices=["stop", "hold"], default="stop")
        p.add_argument("--only-changed", action="store_true")
        if name == "daily":
            p.add_argument("--date", required=True)
        else:
            p.add_argument("--start", required=True)
            p.add_argument("--end", required=True)
    sub.add_parser("vacuum").add_argument("--warehouse", required=True)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf", required=True)
    q.add_argument("--out", required=True)
    sub.add_parser("list")
    a = ap.parse_args(argv)

    from gridmix.plans import catalog

    catalog.load_all()
    if a.cmd == "list":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    spark = _session()
    if a.cmd == "query":
        catalog.QUERIES[a.name](spark, a.sf).write.mode("overwrite").parquet(a.out)
        return 0

    from gridmix import session
    from gridmix.plans import increments
    from gridmix.sinks.versions import Store
    from gridmix.sources.tables import read_silver_generation

    if a.cmd == "vacuum":
        print(f"{Store(spark, a.warehouse).vacuum()} folders removed")
        return 0
    start, end = (a.date, a.date) if a.cmd == "daily" else (a.start, a.end)
    checks = increments.declared_checks if a.gate == "all" else increments.key_integrity_checks
    options = {"gate_checks": checks, "countries": _countries(a.countries), "on_failure": a.on_failure}
    with session.scratch(spark):  # what a run writes to pass on is removed when it is published
        if a.bronze:
            at = increments.Layout(a.bronze, {"silver_generation": f"{a.silver}/generation",
                                              "silver_weather": f"{a.silver}/weather", "warehouse": a.warehouse})
            increments.run_range(spark, at, start, end, only_changed=a.only_changed, **options)
        else:
            increments.ingest(read_silver_generation(spark, a.raw), a.silver, start, end, options["countries"])
            increments.publish_marts(spark, a.silver, a.warehouse, start, end, **options)
    return 0


if __name__ == "__main__":
    sys.exit(main())
