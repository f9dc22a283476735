"""hourcast: hourly observation analytics as Spark DataFrame operators.

Sub-packages
------------
sources    readers and writers (text, lake, CSV, HTML-embedded JSON, snapshots)
functions  column expressions (time parts, cyclic encodings, bands, text helpers, p-value tails)
operators  DataFrame -> DataFrame operators (cleaning, profiling, tests, ranks, splits, encoders, models)
plans      adapters from the driver tables, end-to-end pipelines and the query catalog
streaming  Structured Streaming jobs (incremental ingest, rolling daily summary)
"""

__version__ = "0.1.0"
