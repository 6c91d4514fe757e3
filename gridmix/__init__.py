"""gridmix — electricity-grid and weather analytics as Spark DataFrame transforms.

Layers (each a ``DataFrame -> DataFrame`` function, no driver collects):

* ``gridmix.sources``   raw inputs: silver generation / weather tables, XML documents,
  weather cubes, CSV seeds, the country config, bronze file listings
* ``gridmix.functions`` Column helpers (code->name maps, unit conversions, ISO durations)
* ``gridmix.operators`` staging, intermediate and mart models, data-quality checks
* ``gridmix.plans``     end-user report queries and the daily / backfill pipeline
* ``gridmix.sinks``     partitioned, idempotent Parquet writers
* ``gridmix.streaming`` file-stream increments (``availableNow`` + ``foreachBatch``)
"""

__version__ = "0.1.0"
