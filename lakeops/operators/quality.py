"""Data-quality measures, gates and the shape of their log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the log, and in the functions below the titles of its measures.
DQ_LOG_SCHEMA = T.StructType([
    T.StructField(name, kind) for name, kind in [
        ("DqCheckDate", T.DateType()),
        ("DqCheckType", T.StringType()),
        ("NotebookName", T.StringType()),
        ("SourceDataAsset", T.StringType()),
        ("SourceDataAssetPath", T.StringType()),
        ("TargetDataAsset", T.StringType()),
        ("TargetDataAssetPath", T.StringType()),
        ("SchemaReference", T.StringType()),
        ("FirstRecordMeasureTitle", T.StringType()),
        ("FirstRecordMeasureValue", T.LongType()),
        ("SecondRecordMeasureTitle", T.StringType()),
        ("SecondRecordMeasureValue", T.LongType()),
        ("PrimaryKeyChecked", T.StringType()),
        ("DataAssetFilesChecked", T.StringType()),
        ("__CreatedOn", T.TimestampType()),
        ("__UpdatedOn", T.TimestampType()),
    ]
])


# The names of the checks and the titles of their two measures.
SCHEMA, DUPLICATION, PRIMARY_KEY, COUNT = "SchemaConsistency", "Duplication", "PrimaryKeyConsistency", "CountIntegrity"
TITLES = {
    SCHEMA: ("NumRecordsCompliant", "NumRecordsNonCompliant"),
    DUPLICATION: ("NumTotalRecords", "NumDistinctRecords"),
    PRIMARY_KEY: ("NumDuplicatedPrimaryKeys", "NumPrimaryKeys"),
    COUNT: ("NumRecordsInSource", "NumRecordsInTarget"),
}


class DataQualityError(Exception):
    """A gate did not hold; ``log_row`` is the DQ log entry of the failed check."""

    def __init__(self, message: str, log_row: dict):
        super().__init__(message)
        self.log_row = log_row


def schema_measures(corrupt: str = "__corrupt_record") -> dict[str, Column]:
    """Compliant and non-compliant rows, as aggregates."""
    return {
        "NumRecordsCompliant": F.count_if(F.col(corrupt).isNull()), "NumRecordsNonCompliant": F.count_if(F.col(corrupt).isNotNull()),
    }


def schema_counts(df: DataFrame, corrupt: str = "__corrupt_record") -> DataFrame:
    """Compliant and non-compliant rows in one pass."""
    return df.agg(*[c.alias(name) for name, c in schema_measures(corrupt).items()])


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Total, distinct and duplicated rows; equal rows are combined before the shuffle."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__rows"))
    total, distinct = F.coalesce(F.sum("__rows"), F.lit(0)), F.count(F.lit(1))
    return rows.agg(
        total.alias("NumTotalRecords"),
        distinct.alias("NumDistinctRecords"),
        (total - distinct).alias("NumDuplicatedRecords"),
    )


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of keys and of rows that share their key.

    A composite key with nulls counts as a key; a single null key does not.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    counted = F.lit(True) if len(keys) > 1 else F.col(keys[0]).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col("__rows") > 1, F.col("__rows"))), F.lit(0)).alias("NumDuplicatedPrimaryKeys"),
        F.count_if(counted).alias("NumPrimaryKeys"),
    )


def row_and_key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """The duplicate counts of ``df`` and the key counts of its distinct rows, in one job.

    Equal rows are combined first and their groups then combined by key, so the
    table itself is shuffled once at most.
    """
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__rows"))
    per_key = rows.groupBy(*keys).agg(F.sum("__rows").alias("__rows"), F.count(F.lit(1)).alias("__distinct"))
    counted = F.lit(True) if len(keys) > 1 else F.col(keys[0]).isNotNull()
    total, distinct = (F.coalesce(F.sum(c), F.lit(0)) for c in ("__rows", "__distinct"))
    shared = F.sum(F.when(F.col("__distinct") > 1, F.col("__distinct")))
    return per_key.agg(
        total.alias("NumTotalRecords"), distinct.alias("NumDistinctRecords"), (total - distinct).alias("NumDuplicatedRecords"),
        F.coalesce(shared, F.lit(0)).alias("NumDuplicatedPrimaryKeys"), F.count_if(counted).alias("NumPrimaryKeys"),
    )


def count_integrity(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of the batch and rows of the target that should hold it."""
    in_target = target.agg(F.count(F.lit(1)).alias("n")).scalar()
    return source.agg(F.count(F.lit(1)).alias("NumRecordsInSource")).withColumn(
        "NumRecordsInTarget", in_target
    )


def checked(check: str, first: int, second: int, checked_on, **details) -> dict:
    """The log row of one of the checks above, with the titles of its measures."""
    one, two = TITLES[check]
    return log_entry(check, (one, first), (two, second), checked_on, **details)


def log_entry(check: str, first: tuple[str, int], second: tuple[str, int], checked_on, **details) -> dict:
    """One DQ log row as a dict; ``checked_on`` is the time of the run."""
    return {
        "DqCheckDate": checked_on.date(),
        "DqCheckType": check,
        "FirstRecordMeasureTitle": first[0],
        "FirstRecordMeasureValue": first[1],
        "SecondRecordMeasureTitle": second[0],
        "SecondRecordMeasureValue": second[1],
        "__CreatedOn": checked_on,
        "__UpdatedOn": checked_on,
        **details,
    }


def require(holds: bool, message: str, entry: dict) -> None:
    """Raise with the log row when a check failed."""
    if not holds:
        raise DataQualityError(message, entry)


def latest_measures(log: DataFrame) -> DataFrame:
    """Per asset, check and date, the measures logged last."""
    last = F.max_by(
        F.struct("FirstRecordMeasureTitle", "FirstRecordMeasureValue",
                 "SecondRecordMeasureTitle", "SecondRecordMeasureValue"),
        "__CreatedOn",
    ).alias("last")
    return log.groupBy("SourceDataAsset", "DqCheckType", "DqCheckDate").agg(last).select(
        "SourceDataAsset", "DqCheckType", "DqCheckDate", "last.*"
    )
