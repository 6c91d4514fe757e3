"""Named queries: models, reports, quality checks, bronze decoding and pipeline runs.

``catalog.QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``catalog.ORACLE`` maps the
same names to DuckDB SQL over the driver's tables.
"""
