"""A lake of web events on PySpark: bronze NDJSON, silver Parquet, daily marts."""
