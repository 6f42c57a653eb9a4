"""S, K, Q1, P10 and R5 to R7: the given tables written as raw files and read back."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.catalog.base import query
from lakeops.durable import fresh_path, materialize
from lakeops.functions.scalars import partition_date
from lakeops.operators import quality, shape
from lakeops.plans import conform, feeds, ingest, serve
from lakeops.sinks import tables
from lakeops.sources import files, metadata

EVENT = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
])
FOLDERS = {"year": "yyyy", "month": "MM", "day": "dd"}


def raw_events(t):
    """Events with the folder columns."""
    parts = {n: F.date_format("ts", f) for n, f in FOLDERS.items()}
    return t.events.withColumns(parts).select(*EVENT.names, *FOLDERS)


def landed_json(t):
    """Events as JSON by day, where the values of errors are no numbers."""
    path = fresh_path(t.spark, "json")
    bad = F.to_json(F.struct(*EVENT.names[:3], F.lit("n/a").alias("value")))
    line = F.when(F.col("event_type") == "error", bad).otherwise(F.to_json(F.struct(*EVENT.names)))
    raw_events(t).select(line.alias("line"), *FOLDERS).write.partitionBy(*FOLDERS).text(path)
    return files.scan_json(t.spark, path, files.raw_schema(EVENT))


@query("s1_scan_json", """
    SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value, event_type = 'error' AS is_corrupt FROM events""")
def scan_json(t):
    return landed_json(t).select("event_id", "event_type", "value", F.col(files.CORRUPT).isNotNull().alias("is_corrupt"))


@query("s2_scan_delimited", "SELECT doc_id, md5(text) AS digest, lang FROM documents")
def scan_delimited(t):
    # whole texts with their line breaks, bars and quotes
    path = fresh_path(t.spark, "delimited")
    rows = t.documents.select("doc_id", "text", "lang")
    rows.write.options(sep="|", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return files.scan_delimited(t.spark, path, rows.schema).select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "lang")


@query("s3_scan_xml", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_xml(t):
    path = fresh_path(t.spark, "xml")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    rows.write.format("xml").options(rootTag="customers", rowTag="customer").save(path)
    return files.scan_xml(t.spark, path, "customer", rows.schema)


@query("s4_empty_feed", "SELECT c_custkey, c_name FROM customer")
def empty_feed(t):
    known = t.customer.select("c_custkey", "c_name")
    absent = files.scan_xml(t.spark, fresh_path(t.spark, "absent"), "customer", known.schema, empty_when_missing=True)
    return known.unionByName(absent)


@query("s5_schema_from_metadata", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def schema_from_metadata(t):
    names = {"bigint": "Long", "int": "Integer", "double": "Double", "string": "String"}
    described = t.spark.createDataFrame(
        [("supplier", c, names[k], "true" if c == "s_suppkey" else "false") for c, k in t.supplier.dtypes],
        "FileName string, ColumnName string, DataType string, PrimaryKey string",
    )
    schema, keys = metadata.schema_and_keys(described, "supplier")
    path = fresh_path(t.spark, "described")
    t.supplier.write.options(sep="|", header=True).csv(path)
    return files.scan_delimited(t.spark, path, schema, multiline=False).dropna(subset=keys)


@query("s6_partition_date", "SELECT event_id, CAST(ts AS DATE) AS d FROM events")
def folder_date(t):
    return raw_events(t).select("event_id", partition_date(F.col("year"), F.col("month"), F.col("day")).alias("d"))


def by_type(t):
    path = fresh_path(t.spark, "provenance")
    t.events.select("event_id", "event_type").withColumn("folder", F.col("event_type")).write.partitionBy("folder").json(path)
    return files.with_provenance(files.scan_json(t.spark, path, T.StructType.fromDDL("event_id bigint, event_type string")))


@query("s7_provenance", "SELECT event_id, event_type AS folder, TRUE AS has_time FROM events")
def provenance(t):
    return by_type(t).select(
        "event_id", F.regexp_extract("__RawFileName", "folder=([a-z]+)/", 1).alias("folder"),
        F.col("__RawFileModificationTime").isNotNull().alias("has_time"),
    )


@query("s8_files_processed", "SELECT DISTINCT event_type AS folder FROM events")
def files_processed(t):
    return files.files_processed(by_type(t)).select(F.regexp_extract("__RawFileName", "folder=([a-z]+)/", 1).alias("folder")).distinct()


@query("s11_csv_with_dates", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def csv_with_dates(t):
    path = fresh_path(t.spark, "dates")
    t.orders.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "MM/dd/yyyy HH:mm").alias("o_orderdate")).write.option("header", True).csv(path)
    rows = files.scan_csv(t.spark, path, {"o_orderdate": "MM/dd/yyyy HH:mm"})
    return rows.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_totalprice", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))


@query("s12_western_code_page", r"""
    SELECT doc_id, md5(regexp_replace(text, '\s+', ' ', 'g')) AS digest FROM documents""")
def western_code_page(t):
    path = fresh_path(t.spark, "cp1252")
    rows = t.documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.regexp_replace("text", r"\s+", " ").alias("text"))
    with files.western_charsets(t.spark):
        rows.write.options(header=True, encoding="windows-1252", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
        # read while the setting holds, and go on from the copy
        back = materialize(files.scan_cp1252(t.spark, path), "utf8")
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("digest"))


@query("s13_table_scan", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def table_scan(t):
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    name = new_table(t, rows)
    return serve.conformed_rows(t.spark, name)


def new_table(t, rows, partitions=None):
    """A new table over ``rows``, written to a path of its own."""
    root = fresh_path(t.spark, "table")
    name = "t_" + root[-32:]
    tables.create_if_absent(t.spark, name, rows.schema, f"{root}/empty", partitions)
    tables.point_at(t.spark, name, tables.write_version(rows, root, partitions), partitions)
    return name


def labelled(t):
    path = fresh_path(t.spark, "labelled")
    rows = t.documents.select("text", F.col("lang").alias("split"), F.col("source").alias("label"))
    rows.write.partitionBy("split", "label").text(path)
    return files.scan_labelled_files(t.spark, path, "*.txt")


@query("s14_labelled_files", "SELECT DISTINCT lang AS split, source AS label FROM documents")
def labelled_files(t):
    found = labelled(t).select(*[F.regexp_replace(c, "^.*=", "").alias(c) for c in ("split", "label")])
    return found.distinct()


@query("s15_folder_inventory", """
    SELECT lang || '/' || source AS folder, TRUE AS has_files, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY 1""")
def folder_inventory(t):
    found = files.folder_inventory(labelled(t))
    name = F.regexp_replace("folder", r"^.*/split=([^/]*)/label=([^/]*)$", "$1/$2")
    return found.select(name.alias("folder"), (F.col("files") > 0).alias("has_files"), "bytes")


@query("s16_scan_lines", r"""
    SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""")
def scan_lines(t):
    path = fresh_path(t.spark, "lines")
    t.documents.select("text").write.text(path)
    return files.scan_lines(t.spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("k1_create_if_absent", "SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events")
def create_if_absent(t):
    rows = t.events.select("event_id", "user_id", F.col("ts").cast("date").alias("d"))
    name = new_table(t, rows, ["d"])
    # the second call finds the table and changes nothing
    tables.create_if_absent(t.spark, name, rows.schema, fresh_path(t.spark, "unused"), ["d"])
    return t.spark.table(name)


@query("k2_overwrite_partitions", """
    SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17' THEN value + 1 ELSE value END AS value,
           CAST(ts AS DATE) AS d FROM events""")
def overwrite_partitions(t):
    path = fresh_path(t.spark, "partitions")
    rows = t.events.select("event_id", "value", F.col("ts").cast("date").alias("d"))
    tables.overwrite_partitions(rows, path, ["d"])
    week = shape.date_window(rows, "d", "2024-01-10", "2024-01-17").withColumn("value", F.col("value") + 1)
    tables.overwrite_partitions(week, path, ["d"], tasks_per_partition=2)
    return t.spark.read.schema(rows.schema).parquet(path)


@query("k3_append_log", """
    SELECT 'events.' || event_type AS SourceDataAsset, 'CountIntegrity' AS DqCheckType, count(*) AS FirstRecordMeasureValue, count(*) AS SecondRecordMeasureValue
    FROM events GROUP BY 1""")
def append_log(t):
    path = fresh_path(t.spark, "log")
    n, now = F.count(F.lit(1)), F.lit(datetime(2024, 2, 1))
    entries = t.events.groupBy(F.concat(F.lit("events."), "event_type").alias("SourceDataAsset")).agg(
        n.alias("FirstRecordMeasureValue"), n.alias("SecondRecordMeasureValue"),
    ).withColumns({
        "DqCheckType": F.lit("CountIntegrity"), "FirstRecordMeasureTitle": F.lit("NumRecordsInSource"),
        "SecondRecordMeasureTitle": F.lit("NumRecordsInTarget"), "DqCheckDate": now.cast("date"), "__CreatedOn": now,
    })
    tables.append_log(t.spark, entries, path)
    return tables.read_log(t.spark, path).select("SourceDataAsset", "DqCheckType", "FirstRecordMeasureValue", "SecondRecordMeasureValue")


@query("k6_csv_export", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def csv_export(t):
    path = fresh_path(t.spark, "export")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    tables.export_csv(rows, path)
    return files.scan_csv(t.spark, path, schema=rows.schema)


@query("p10_compliant_split", """
    SELECT event_type <> 'error' AS compliant, count(*) AS n FROM events GROUP BY 1""")
def compliant_split(t):
    # the corrupt column is read along with others, so the scan is landed first
    good, bad = shape.split_compliant(materialize(landed_json(t), "split"))
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(ok).alias("compliant"), "n") for ok, df in ((True, good), (False, bad))
    ]
    return counted[0].unionByName(counted[1])


@query("q1_schema_counts", """
    SELECT count(*) FILTER (event_type <> 'error') AS NumRecordsCompliant, count(*) FILTER (event_type = 'error') AS NumRecordsNonCompliant FROM events""")
def schema_counts(t):
    return quality.schema_counts(materialize(landed_json(t), "counted"))


@query("q5_gate", "SELECT 'PrimaryKeyConsistency' AS failed_check, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def gate(t):
    found = quality.key_counts(t.lineitem, ["l_orderkey", "l_linenumber"]).first()
    entry = quality.log_entry(
        "PrimaryKeyConsistency", ("NumDuplicatedPrimaryKeys", found[0]), ("NumPrimaryKeys", found[1]), datetime(2024, 2, 1)
    )
    failed = (None, None)
    try:
        quality.require(found[0] == 0, "rows share a key", entry)
    except quality.DataQualityError as error:
        failed = (error.log_row["DqCheckType"], error.log_row["FirstRecordMeasureValue"])
    return t.spark.createDataFrame([failed], "failed_check string, n bigint")


@query("r5_run_feeds", "SELECT DISTINCT event_type AS feed, 'loaded' AS status, CAST(1 AS INTEGER) AS attempts FROM events")
def run_feeds(t):
    root = fresh_path(t.spark, "feeds")
    names = [r[0] for r in t.events.select("event_type").distinct().collect()]

    def load(feed):
        t.events.where(F.col("event_type") == feed).write.parquet(f"{root}/{feed}")
    return feeds.run_feeds(t.spark, names, load).drop("seconds", "error")


def event_feed(t, sub):
    """A feed of events in two file versions per day; the later one corrects the values of clicks."""
    root = fresh_path(t.spark, sub)
    feed = ingest.Feed("events", f"{root}/raw", f"{root}/cleaned", f"{root}/log", EVENT, ["event_id"], multiline=False)
    options = {"sep": "|", "header": True}
    first = raw_events(t)
    first.write.options(**options).partitionBy(*FOLDERS).csv(feed.raw_path)
    return feed, first, options


@query("r6_ingest_cleaned", """
    SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS d FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-29'""")
def ingest_cleaned(t):
    feed, _, _ = event_feed(t, "ingest")
    now = datetime(2024, 2, 1)
    for first, last in (("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-01-29")):
        start, end = ingest.parse_window(f"{first}T00:00:00Z", f"{last}T00:00:00Z")
        ingest.ingest_cleaned(t.spark, feed, start, end, now)
    cleaned = t.spark.read.parquet(feed.cleaned_path)
    return cleaned.select("event_id", "user_id", "event_type", "value", F.col("__RawPartitionDate").alias("d"))


@query("q6_quality_log", """
    SELECT * FROM (SELECT count(*) AS n FROM events), (VALUES
      ('SchemaConsistency', 'NumRecordsCompliant', 'NumRecordsNonCompliant'), ('Duplication', 'NumTotalRecords', 'NumDistinctRecords'),
      ('PrimaryKeyConsistency', 'NumPrimaryKeys', 'NumDuplicatedPrimaryKeys'), ('CountIntegrity', 'NumRecordsInSource', 'NumRecordsInTarget'))
      v("check", counted, other)""")
def quality_log(t):
    feed, _, _ = event_feed(t, "logged")
    ingest.ingest_cleaned(t.spark, feed, datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 2, 1))
    log = tables.read_log(t.spark, feed.log_path)
    # the key check names its duplicates first
    swap = F.col("DqCheckType") == "PrimaryKeyConsistency"
    one, two = F.col("FirstRecordMeasureTitle"), F.col("SecondRecordMeasureTitle")
    return log.select(
        F.col("DqCheckType").alias("check"), F.when(swap, two).otherwise(one).alias("counted"), F.when(swap, one).otherwise(two).alias("other"),
        F.when(swap, F.col("SecondRecordMeasureValue")).otherwise(F.col("FirstRecordMeasureValue")).alias("n"),
    )


@query("r6_ingest_upsert", """
    SELECT event_id, CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS value, event_type = 'click' AS corrected,
           CASE WHEN event_type = 'click' THEN DATE '2024-03-05' ELSE CAST(ts AS DATE) END AS d FROM events""")
def ingest_upsert(t):
    feed, first, options = event_feed(t, "upsert")
    start, end = datetime(2024, 1, 1), datetime(2024, 2, 1)
    ingest.ingest_cleaned(t.spark, feed, start, end, datetime(2024, 2, 1))
    # a second feed folder brings corrected rows only, on a later day, which update by key
    later = ingest.Feed(**{**feed.__dict__, "raw_path": feed.raw_path + "-later"})
    clicks = first.where("event_type = 'click'").withColumns({
        "value": F.col("value") + 1, "year": F.lit("2024"), "month": F.lit("03"), "day": F.lit("05"),
    })
    clicks.write.options(**options).partitionBy(*FOLDERS).csv(later.raw_path)
    ingest.ingest_cleaned(t.spark, later, datetime(2024, 3, 1), datetime(2024, 4, 1), datetime(2024, 4, 1), mode="upsert")
    cleaned = t.spark.read.parquet(feed.cleaned_path)
    return cleaned.select(
        "event_id", "value", (F.col("__UpdatedOn") > F.col("__CreatedOn")).alias("corrected"), F.col("__RawPartitionDate").alias("d"),
    )


@query("r7_conform_scd2", """
    SELECT c_custkey, count(*) AS versions, count(*) FILTER (cur) AS current, max(bal) FILTER (cur) AS c_acctbal FROM (
      SELECT c_custkey, c_acctbal >= 0 AS cur, c_acctbal AS bal FROM customer
      UNION ALL SELECT c_custkey, TRUE, c_acctbal + 100 FROM customer WHERE c_acctbal < 0) GROUP BY 1""")
def conform_scd2(t):
    root = fresh_path(t.spark, "dimension")
    name, log = "dim_" + root[-32:], f"{root}-log"
    source = t.customer.select("c_custkey", "c_name", "c_acctbal")
    conform.conform_scd2(t.spark, name, root, source, "c_custkey", "load-1", datetime(2024, 1, 1), "ERP", log)
    moved = F.when(F.col("c_acctbal") < 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    for _ in range(2):  # the same load again changes nothing
        conform.conform_scd2(
            t.spark, name, root, source.withColumn("c_acctbal", moved), "c_custkey", "load-2", datetime(2024, 2, 1), "ERP", log
        )
    return t.spark.table(name).groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("versions"), F.count_if("CurrInd").alias("current"),
        F.max(F.when(F.col("CurrInd"), F.col("c_acctbal"))).alias("c_acctbal"),
    )


@query("r7_conform_scd1", """
    SELECT o_custkey AS id, arg_max(p, d) AS price, max(d) AS d FROM (
      SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) AS p FROM orders GROUP BY 1, 2) GROUP BY 1
    UNION ALL SELECT -1, NULL, NULL""")
def conform_scd1(t):
    root = fresh_path(t.spark, "flat")
    name, log = "flat_" + root[-32:], f"{root}-log"
    cleaned = t.orders.groupBy(F.col("o_custkey").alias("id"), F.col("o_orderdate").cast("date").alias("d")).agg(F.max("o_totalprice").alias("price"))
    for start, end in (("1990-01-01", "1998-01-01"), ("1998-01-01", "2030-01-01")):
        conform.conform_scd1(t.spark, name, root, cleaned, "id", "d", start, end, {"id": -1}, datetime(2024, 2, 1), log)
    return t.spark.table(name).select("id", "price", "d")
