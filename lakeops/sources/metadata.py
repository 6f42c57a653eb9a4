"""Schemas from a table with one row per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names of the metadata table.
TYPES = {
    "String": T.StringType(),
    "Integer": T.IntegerType(),
    "Long": T.LongType(),
    "Short": T.ShortType(),
    "Double": T.DoubleType(),
    "Float": T.FloatType(),
    "Boolean": T.BooleanType(),
    "Date": T.DateType(),
    "Timestamp": T.TimestampType(),
    "Byte": T.ByteType(),
    "Binary": T.BinaryType(),
    "Decimal": T.DecimalType(),
}


def schema_and_keys(metadata: DataFrame, file_name: str) -> tuple[T.StructType, list[str]]:
    """Column types and key columns of one feed.

    Only the feed's own rows, one per column of one file, reach the driver.
    """
    rows = metadata.where(F.col("FileName") == file_name).collect()
    if not rows:
        raise ValueError(f"no columns described for {file_name}")
    unknown = sorted({r["DataType"] for r in rows} - set(TYPES))
    if unknown:
        raise ValueError(f"unknown data types {unknown} for {file_name}")
    schema = T.StructType([T.StructField(r["ColumnName"], TYPES[r["DataType"]]) for r in rows])
    return schema, [r["ColumnName"] for r in rows if str(r["PrimaryKey"]).lower() == "true"]
