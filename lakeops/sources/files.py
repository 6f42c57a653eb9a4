"""Scans of raw files."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.functions.scalars import partition_date

CORRUPT = "__corrupt_record"
PARTITION_FOLDERS = ["year", "month", "day"]


def raw_schema(business: StructType) -> StructType:
    """Business columns, the corrupt record and the three partition folders."""
    extra = [CORRUPT, *PARTITION_FOLDERS]
    return StructType([*business.fields, *[StructField(c, StringType()) for c in extra]])


def scan_json(spark: SparkSession, path: str, schema: StructType, timestamp_format: str | None = None) -> DataFrame:
    """Permissive JSON scan; rows that do not fit keep their text in the corrupt column."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if timestamp_format:
        options["timestampFormat"] = timestamp_format
    return spark.read.schema(schema).options(**options).json(path)


def scan_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = "|", multiline: bool = True) -> DataFrame:
    """Permissive delimited scan with a header and values over several lines.

    A file with multi-line values cannot be split, so one task reads it; leave
    ``multiline`` off for large files that have none.
    """
    return spark.read.schema(schema).options(
        sep=sep, header=True, multiLine=multiline, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    ).csv(path)


def scan_xml(
    spark: SparkSession, path: str, row_tag: str, schema: StructType | None = None, empty_when_missing: bool = False
) -> DataFrame:
    """XML scan by row tag; empty text is null.

    With ``empty_when_missing`` a feed without data gives an empty frame of
    ``schema``; otherwise the missing path raises.
    """
    reader = spark.read.format("xml").options(rowTag=row_tag, nullValue="")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as missing:
        if empty_when_missing and schema is not None and missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def scan_csv(
    spark: SparkSession, path: str, dates: dict[str, str] | None = None, schema: StructType | None = None
) -> DataFrame:
    """CSV with a header; ``dates`` maps columns to their format, bad ones become null.

    Without a schema the types are inferred, which reads the files once more.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.withColumns({
        c: F.try_to_timestamp(F.col(c).cast("string"), F.lit(f)) for c, f in (dates or {}).items()
    })


@contextmanager
def western_charsets(spark: SparkSession):
    """Let Spark take code pages beyond its short list, and put the setting back."""
    name = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scan_cp1252(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV in the Windows western code page; all columns are text without a schema.

    To be run inside ``western_charsets``: land the frame there and go on from the copy.
    """
    reader = spark.read.options(header=True, encoding="windows-1252")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def with_partition_date(df: DataFrame, name: str = "__RawPartitionDate") -> DataFrame:
    """Add the date of the ``year=/month=/day=`` folders.

    The expression uses the folder columns alone, so a filter on it prunes folders.
    """
    return df.withColumn(name, partition_date(*[F.col(c) for c in PARTITION_FOLDERS]))


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the name and modification time of the file of each row, from the scan itself."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("__RawFileName"),
        F.col("_metadata.file_modification_time").alias("__RawFileModificationTime"),
    )


def files_processed(df: DataFrame) -> DataFrame:
    """The files the rows came from."""
    return df.select("__RawFileName").distinct()


def scan_labelled_files(spark: SparkSession, folder: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """Files below ``folder`` with the parent folder as label and its parent as split."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    parts = F.split("path", "/")
    labelled = files.withColumns({"label": F.element_at(parts, -2), "split": F.element_at(parts, -3)})
    return labelled if content else labelled.drop("content")


def folder_inventory(files: DataFrame) -> DataFrame:
    """Files and bytes per folder."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")
    return files.groupBy(folder).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")
