"""gridspark: gridded-array ingestion on Spark.

File-arrival notifications are parsed and matched against per-measure extraction
parameters; each announced grid is read as slabs (one row per realization / y line)
and unpivoted into long rows with native DataFrame operators; results go to SQL
tables or JSON files, in batch or as a Structured Streaming query.
"""

__all__ = ["schema", "session"]
