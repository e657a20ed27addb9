"""tickvault: a Spark-native market-data warehouse.

Every operator is a plain function ``f(df, ..., params) -> DataFrame`` that
builds a lazy plan with the DataFrame API, so Catalyst does the pushdown,
pruning and physical planning.  Sub-packages:

* ``functions``  column expressions (symbols, time, first/last helpers)
* ``operators``  table operators (bars, dedupe, rolls, calendar, coverage,
  checks, curves, windows, set operations)
* ``sources``    readers and sinks (keyed upserts on partitioned Parquet)
* ``streaming``  Structured Streaming forms of the incremental jobs
* ``plans``      test fixtures, the query catalogue and composed jobs
"""

__version__ = "0.1.0"
