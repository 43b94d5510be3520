"""scholarspark: analytics over scholarly-record data, written as Spark DataFrame plans.

Every public operator takes and returns DataFrames (or Columns); the caller owns the
SparkSession. Sub-packages:

- ``sources``    reading tables, landed JSON pages and lookup responses; sinks
- ``functions``  Column-level expressions (dates, citation timespans, text, recoding)
- ``operators``  DataFrame -> DataFrame operators (dedup, upsert, search, statistics, ML)
- ``plans``      the named end-to-end queries and their SQL oracles
- ``streaming``  Structured Streaming jobs (incremental landing, keep-latest upsert)
"""

__version__ = "0.1.0"
