"""sparkmart: a retail star-schema ETL and OLAP engine written as Spark jobs.

Sub-packages:
  sources    readers and writers (CSV inputs, Parquet star, JDBC), test-data star
  functions  Column -> Column scalar expressions (dates, rounding, ratios)
  operators  reusable DataFrame operators (joins, dedupe, dims, quality, affinity)
  plans      the analytical reports and the query registry
  streaming  Structured Streaming fact loader
"""

__version__ = "0.1.0"
