"""Raw files to a cleaned table: scan, gates, latest version, write, integrity."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.durable import materialize_measured, passing_stages
from lakeops.operators import quality
from lakeops.operators.merge import upsert
from lakeops.operators.ranking import latest_per_key
from lakeops.operators.shape import date_window, in_date_window
from lakeops.sinks import tables
from lakeops.sources import files

DATE = "__RawPartitionDate"


def parse_window(start: str, end: str = "") -> tuple[datetime, datetime]:
    """Window bounds from ISO-8601 text, with or without a fraction; one day by default."""
    def parse(text: str) -> datetime:
        whole, _, fraction = text.rstrip("Z").partition(".")
        return datetime.fromisoformat(whole) + timedelta(microseconds=int(fraction[:6].ljust(6, "0") or 0))
    if not start:
        raise ValueError("a window start is needed, as 2024-01-31T00:00:00Z")
    first = parse(start)
    return first, parse(end) if end else first + timedelta(days=1)


@dataclass
class Feed:
    """One raw feed and where it goes."""

    name: str
    raw_path: str
    cleaned_path: str
    log_path: str
    schema: StructType
    keys: list[str]
    kind: str = "csv"  # or json
    multiline: bool = False  # a file with line ends inside values cannot be split


def scan_feed(spark: SparkSession, feed: Feed, start: datetime, end: datetime) -> DataFrame:
    """The feed's rows of the window, with provenance; folders outside it are not read."""
    schema = files.raw_schema(feed.schema)
    raw = (
        files.scan_json(spark, feed.raw_path, schema) if feed.kind == "json"
        else files.scan_delimited(spark, feed.raw_path, schema, multiline=feed.multiline)
    )
    dated = files.with_partition_date(files.with_provenance(raw), DATE)
    windowed = date_window(dated, DATE, start.date().isoformat(), end.date().isoformat())
    return windowed.withColumns({
        "__WindowStartTime": F.lit(start).cast("timestamp"),
        "__WindowEndTime": F.lit(end).cast("timestamp"),
    })


def ingest_cleaned(
    spark: SparkSession, feed: Feed, start: datetime, end: datetime, load_ts: datetime, mode: str = "partitions"
) -> dict[str, int]:
    """Load one window of a feed into its cleaned table and log every check.

    ``mode`` is ``partitions`` (replace the days of the batch) or ``upsert`` (update by
    business key: a key that comes again on a later day moves there). The scan is
    written once; checks and the table are made from that copy.
    """
    checks = _Checks(spark, feed, load_ts)
    with passing_stages(spark):
        try:
            return _load(spark, feed, start, end, load_ts, mode, checks)
        finally:
            checks.write()


def _load(spark, feed, start, end, load_ts, mode, checks) -> dict[str, int]:
    # what the gates count is counted once, on the copies, from the columns it needs
    batch, fits = materialize_measured(scan_feed(spark, feed, start, end), "batch", quality.schema_measures(files.CORRUPT))
    n_files, checks.files = _list_files(batch, feed.log_path)
    good, bad = fits["NumRecordsCompliant"], fits["NumRecordsNonCompliant"]
    checks.run(quality.SCHEMA, good, bad, holds=bad == 0, message=f"{bad} rows do not fit the schema in {checks.files}")
    keys = [*feed.keys, DATE]
    rows, held = materialize_measured(latest_per_key(batch.drop(files.CORRUPT), keys, "__RawFileModificationTime"), "latest")
    # once the first of these holds the rows are distinct, so no DISTINCT is needed further on
    found = quality.row_and_key_counts(rows, keys).first()
    checks.run(
        quality.DUPLICATION, found["NumTotalRecords"], found["NumDistinctRecords"],
        holds=found["NumDuplicatedRecords"] == 0, message=f"{found['NumDuplicatedRecords']} duplicated rows",
    )
    checks.run(
        quality.PRIMARY_KEY, found["NumDuplicatedPrimaryKeys"], found["NumPrimaryKeys"],
        holds=found["NumDuplicatedPrimaryKeys"] == 0,
        message=f"{found['NumDuplicatedPrimaryKeys']} rows share a key", keys=", ".join(keys),
    )
    stamp = F.lit(load_ts).cast("timestamp")
    loaded = rows.withColumns({"__CreatedOn": stamp, "__UpdatedOn": stamp})
    if mode == "upsert":
        rows, held = materialize_measured(_latest_day(rows, feed.keys), "upserted")
        loaded = rows.withColumns({"__CreatedOn": stamp, "__UpdatedOn": stamp})
    existing = _existing(spark, feed.cleaned_path, loaded) if mode == "upsert" else None
    in_window = in_date_window(DATE, start.date().isoformat(), end.date().isoformat()) & (F.col("__UpdatedOn") == stamp)
    measures = {"rows": F.count_if(in_window)}
    if existing is not None:
        written = tables.merge_partitions(
            existing, rows, feed.keys, lambda part: upsert(part, rows, feed.keys, stamp), feed.cleaned_path, DATE, measures
        )
    else:
        written = tables.overwrite_partitions(loaded, feed.cleaned_path, [DATE], measures=measures)
    checks.run(
        quality.COUNT, held["rows"], written["rows"],
        holds=held["rows"] == written["rows"], message=f"{held['rows']} rows in the batch, {written['rows']} in the table",
    )
    return {"rows": written["rows"], "files": n_files}


def _latest_day(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of a key on several days of the batch the rows of the latest; rows that lack a part of the key all stay."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return latest_per_key(rows.where(whole), keys, DATE).unionByName(rows.where(~whole))


def _list_files(batch: DataFrame, log_path: str) -> tuple[int, str]:
    """Number of files, and for the log how many and the table that lists them."""
    path = f"{log_path}-files/load={uuid.uuid4().hex}"
    files.files_processed(batch).write.parquet(path)
    count = batch.sparkSession.read.parquet(path).count()
    return count, f"{count} listed in {path}"


def _existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The table at ``path``, or None before the first load."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class _Checks:
    """Keeps the log row of each check and raises on the first that fails.

    The rows are appended in one write, also when a check or the load fails.
    """

    def __init__(self, spark: SparkSession, feed: Feed, load_ts: datetime):
        self.spark, self.feed, self.load_ts, self.files = spark, feed, load_ts, ""
        self.entries: list[dict] = []

    def run(self, check, first, second, holds, message, keys=""):
        entry = quality.checked(
            check, first, second, self.load_ts,
            NotebookName="ingest_cleaned", SourceDataAsset=f"raw.{self.feed.name}",
            SourceDataAssetPath=self.feed.raw_path, TargetDataAsset=f"cleaned.{self.feed.name}",
            TargetDataAssetPath=self.feed.cleaned_path, SchemaReference=self.feed.schema.simpleString(),
            PrimaryKeyChecked=keys, DataAssetFilesChecked=self.files,
        )
        self.entries.append(entry)
        quality.require(holds, f"{self.feed.name}: {message}", entry)

    def write(self):
        if self.entries:
            tables.append_log(self.spark, self.entries, self.feed.log_path)
