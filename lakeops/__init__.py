"""lakeops: table work from raw files to served and scored tables, on Spark."""
