"""spendlens: paid-media reporting as Spark DataFrame jobs.

Subpackages
-----------
functions  column expressions (cleaning, dates, money, ratios)
operators  DataFrame -> DataFrame building blocks (dedup, upsert, zero-fill, ...)
sources    file readers with quarantine, fixed reference tables, snapshot store
plans      table builders (bronze/silver/gold), reports, quality rules, pipeline
streaming  landing-folder ingestion with Structured Streaming
"""

__version__ = "0.1.0"
