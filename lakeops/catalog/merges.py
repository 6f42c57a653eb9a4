"""M and Q: merges, slowly changing dimensions and data-quality measures."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.durable import fresh_path, materialize
from lakeops.operators import merge, quality

TS = "2024-02-01 00:00:00"
OLD_TS = "2024-01-01 00:00:00"


def at(text=TS):
    return F.lit(text).cast("timestamp")


def plain(df, *columns):
    """Timestamps as wall-clock values, as the tables hold them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# the dimension before the load lacks one segment; the batch changes negative balances
def before(t):
    return t.customer.where(F.col("c_mktsegment") != "MACHINERY").select("c_custkey", "c_name", "c_acctbal")


def batch(t):
    moved = F.when(F.col("c_acctbal") < 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    return t.customer.select("c_custkey", "c_name", moved.alias("c_acctbal"))


# the batch of the upsert holds only members that changed or are new
def changed(t):
    return batch(t).join(t.customer.where("c_acctbal < 0 OR c_mktsegment = 'MACHINERY'").select("c_custkey"), "c_custkey", "left_semi")


def upserted(t):
    target = before(t).withColumns({"__CreatedOn": at(OLD_TS), "__UpdatedOn": at(OLD_TS)})
    return merge.merge_actions(target, changed(t), ["c_custkey"], at())


@query("m1_upsert", f"""
    SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN TIMESTAMP '{TS}' ELSE TIMESTAMP '{OLD_TS}' END AS created_on,
           CASE WHEN c_mktsegment = 'MACHINERY' OR c_acctbal < 0 THEN TIMESTAMP '{TS}' ELSE TIMESTAMP '{OLD_TS}' END AS updated_on
    FROM customer""")
def upsert(t):
    rows = plain(upserted(t).drop("__action"), "__CreatedOn", "__UpdatedOn")
    return rows.withColumnsRenamed({"__CreatedOn": "created_on", "__UpdatedOn": "updated_on"})


CLEANED = """(SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS d, max(o_orderpriority) AS code,
              max(o_totalprice) AS price FROM orders GROUP BY 1, 2)"""


def cleaned(t):
    return t.orders.groupBy(F.col("o_custkey").alias("id"), F.col("o_orderdate").cast("date").alias("d")).agg(
        F.max("o_orderpriority").alias("code"), F.max("o_totalprice").alias("price")
    )


@query("m2_scd1_load", f"""
    WITH old AS (SELECT id, code, price, d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d DESC) AS rn
                 FROM {CLEANED} WHERE d < DATE '1997-01-01') WHERE rn = 1),
         new AS (SELECT id, code, price, d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d DESC) AS rn
                 FROM {CLEANED} WHERE d >= DATE '1997-01-01' AND d < DATE '2000-01-01') WHERE rn = 1
                 UNION ALL SELECT -1, '-1', NULL, NULL)
    SELECT coalesce(n.id, o.id) AS id, CASE WHEN n.id IS NULL THEN o.code ELSE n.code END AS code,
           CASE WHEN n.id IS NULL THEN o.price ELSE n.price END AS price,
           CASE WHEN n.id IS NULL THEN o.d ELSE n.d END AS d,
           coalesce(n.id, o.id) = -1 AS unknown_flag,
           CASE WHEN o.id IS NULL THEN TIMESTAMP '{TS}' ELSE TIMESTAMP '{OLD_TS}' END AS created_on,
           CASE WHEN n.id IS NULL THEN TIMESTAMP '{OLD_TS}' ELSE TIMESTAMP '{TS}' END AS updated_on,
           CASE WHEN n.id IS NULL THEN TIMESTAMP '1990-01-01' ELSE TIMESTAMP '1997-01-01' END AS window_start,
           CASE WHEN n.id IS NULL THEN TIMESTAMP '1997-01-01' ELSE TIMESTAMP '2000-01-01' END AS window_end
    FROM old o FULL JOIN new n ON o.id = n.id""")
def scd1_load(t):
    rows = cleaned(t)
    first = merge.scd1_source(rows, "id", "d", "1990-01-01", "1997-01-01", {"id": -1})
    target = first.where("id <> -1").withColumns({"__CreatedOn": at(OLD_TS), "__UpdatedOn": at(OLD_TS)})
    loaded = merge.scd1_apply(target, rows, "id", "d", "1997-01-01", "2000-01-01", {"id": -1, "code": "-1"}, at())
    named = {"__UnknownFlag": "unknown_flag", "__CreatedOn": "created_on", "__UpdatedOn": "updated_on",
             "__WindowStartTime": "window_start", "__WindowEndTime": "window_end"}
    return plain(loaded, "__CreatedOn", "__UpdatedOn", "__WindowStartTime", "__WindowEndTime").withColumnsRenamed(named)


def dimension(t):
    """The dimension as an earlier load left it, written as a table is."""
    return materialize(merge.scd2_initial(before(t), "c_custkey", "load-1", at(OLD_TS), "ERP"), "dimension")


@query("m3_scd2_changes", """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Insert' WHEN c_acctbal < 0 THEN 'Update' ELSE 'None' END
           AS RowAction FROM customer""")
def scd2_changes(t):
    return merge.scd2_changes(dimension(t), batch(t), "c_custkey").select("c_custkey", "RowAction")


SCD2_SQL = f"""
    WITH v1 AS (SELECT c_custkey, c_name, c_acctbal, row_number() OVER (ORDER BY c_custkey) AS Ekid,
                       c_acctbal < 0 AS ends FROM customer WHERE c_mktsegment <> 'MACHINERY'),
         top AS (SELECT count(*) AS n FROM v1),
         v2 AS (SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal, Ekid, TIMESTAMP '{OLD_TS}' AS created
                FROM v1 WHERE ends
                UNION ALL
                SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN c_acctbal + 100 ELSE c_acctbal END,
                       row_number() OVER (ORDER BY c_custkey) + (SELECT n FROM top), TIMESTAMP '{TS}'
                FROM customer WHERE c_mktsegment = 'MACHINERY')
    SELECT Ekid AS Skid, Ekid, c_custkey, c_name, c_acctbal, TIMESTAMP '{OLD_TS}' AS ValidFromDt,
           CASE WHEN ends THEN TIMESTAMP '2024-01-31 23:59:00' ELSE TIMESTAMP '9999-12-31 23:59:59' END AS ValidToDt,
           NOT ends AS CurrInd, TIMESTAMP '{OLD_TS}' AS RecordCreatedDt, 'load-1' AS LoadID FROM v1
    UNION ALL
    SELECT row_number() OVER (ORDER BY Ekid) + (SELECT n FROM top), Ekid, c_custkey, c_name, c_acctbal,
           TIMESTAMP '{TS}', TIMESTAMP '9999-12-31 23:59:59', TRUE, created, 'load-2' FROM v2"""
SCD2_OUT = ["Skid", "Ekid", "c_custkey", "c_name", "c_acctbal", "ValidFromDt", "ValidToDt", "CurrInd", "RecordCreatedDt", "LoadID"]


def loaded(t, target, load_id="load-2"):
    return merge.scd2_apply(target, batch(t), "c_custkey", load_id, at(), "ERP")


@query("m4_scd2_apply", f"SELECT * REPLACE (strftime(ValidToDt, '%Y-%m-%d %H:%M:%S') AS ValidToDt) FROM ({SCD2_SQL})")
def scd2_apply(t):
    rows = plain(loaded(t, dimension(t)).select(SCD2_OUT), "ValidFromDt", "RecordCreatedDt")
    # the open end lies beyond what a nanosecond clock can hold, so it is compared as text
    return rows.withColumn("ValidToDt", F.date_format("ValidToDt", "yyyy-MM-dd HH:mm:ss"))


@query("m5_row_checksum", """
    WITH a AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS x,
                      CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS y FROM orders)
    SELECT o_orderkey, (x IS DISTINCT FROM y) AS changed FROM a""")
def row_checksum(t):
    # the second version swaps two columns, of which one is always null
    split = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("x"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("y"),
    )
    sums = split.select("o_orderkey", merge.row_checksum(["x", "y"]).alias("one"), merge.row_checksum(["y", "x"]).alias("two"))
    return sums.select("o_orderkey", (F.col("one") != F.col("two")).alias("changed"))


@query("m6_infer_members", """
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment, FALSE AS unknown FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL
    SELECT DISTINCT o_custkey, 'NA', NULL::DOUBLE, 'NA', TRUE FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def infer_members(t):
    known = t.customer.where(F.col("c_mktsegment") != "BUILDING").drop("c_nationkey").withColumn("unknown", F.lit(False))
    defaults = {"c_name": F.lit("NA"), "c_mktsegment": F.lit("NA"), "unknown": F.lit(True)}
    return merge.infer_members(known, t.orders, "o_custkey", "c_custkey", defaults)


@query("m7_unknown_member", """
    SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT -1, NULL, -1""")
def unknown_member(t):
    return merge.unknown_member(t.nation, {"n_nationkey": -1, "n_regionkey": -1})


@query("m8_null_key_to_unknown", """
    SELECT o_orderkey, coalesce(c_custkey, -1) AS customer FROM orders
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey""")
def null_key_to_unknown(t):
    known = t.customer.where(F.col("c_mktsegment") != "BUILDING").select(F.col("c_custkey").alias("o_custkey"), F.col("c_custkey").alias("k"))
    found = merge.current_version(t.orders, known.withColumn("CurrInd", F.lit(True)), ["o_custkey"])
    return found.select("o_orderkey", F.coalesce("k", F.lit(-1)).cast("bigint").alias("customer"))


@query("m9_business_key", """
    SELECT c_custkey, (SELECT max(c_custkey) FROM customer WHERE c_mktsegment <> 'MACHINERY')
           + row_number() OVER (ORDER BY c_name) AS ekid FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def business_key(t):
    last = merge.highest(before(t), "c_custkey")
    new = t.customer.where(F.col("c_mktsegment") == "MACHINERY").select("c_custkey", "c_name")
    return merge.number_after(new, ["c_name"], "ekid", last).drop("c_name")


@query("m10_surrogate_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice,
           row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice)
           AS skid FROM lineitem""")
def surrogate_key(t):
    order = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return merge.number_after(t.lineitem.select(order), order, "skid", 0)


@query("m11_rerun_same_load", f"SELECT c_custkey, count(*) AS versions, count(*) FILTER (CurrInd) AS current FROM ({SCD2_SQL}) GROUP BY 1")
def rerun_same_load(t):
    once = materialize(loaded(t, dimension(t)), "once")
    twice = loaded(t, once)
    return twice.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("versions"), F.count_if("CurrInd").alias("current"))


@query("m12_affected_rows", """
    SELECT count(*) FILTER (c_mktsegment = 'MACHINERY') AS num_inserted_rows,
           count(*) FILTER (c_mktsegment <> 'MACHINERY' AND c_acctbal < 0) AS num_updated_rows,
           CAST(0 AS BIGINT) AS num_deleted_rows,
           count(*) FILTER (c_mktsegment = 'MACHINERY' OR c_acctbal < 0) AS num_affected_rows FROM customer""")
def affected_rows(t):
    path = fresh_path(t.spark, "merged")
    counts = merge.write_merged(upserted(t), lambda rows: rows.write.parquet(path))
    return t.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


@query("q2_duplicate_counts", """
    SELECT count(*) AS NumTotalRecords, count(DISTINCT (text, lang, source, n_chars)) AS NumDistinctRecords,
           count(*) - count(DISTINCT (text, lang, source, n_chars)) AS NumDuplicatedRecords FROM documents""")
def duplicate_counts(t):
    return quality.duplicate_counts(t.documents.drop("doc_id"))


@query("q3_key_counts", """
    WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS NumDuplicatedPrimaryKeys, count(*) AS NumPrimaryKeys FROM k""")
def key_counts(t):
    return quality.key_counts(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("q4_count_integrity", """
    SELECT (SELECT count(*) FROM lineitem) AS NumRecordsInSource,
           (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS NumRecordsInTarget""")
def count_integrity(t):
    target = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).join(t.orders.select("o_orderkey"), "o_orderkey")
    return quality.count_integrity(t.lineitem, target)


@query("q7_latest_measures", """
    SELECT event_type AS SourceDataAsset, 'CountIntegrity' AS DqCheckType, CAST(ts AS DATE) AS DqCheckDate,
           'NumRecordsInSource' AS FirstRecordMeasureTitle, arg_max(event_id, ts) AS FirstRecordMeasureValue,
           'NumRecordsInTarget' AS SecondRecordMeasureTitle, arg_max(user_id, ts) AS SecondRecordMeasureValue
    FROM events GROUP BY 1, 2, 3""")
def latest_measures(t):
    log = t.events.select(
        F.col("event_type").alias("SourceDataAsset"), F.lit("CountIntegrity").alias("DqCheckType"),
        F.col("ts").cast("date").alias("DqCheckDate"),
        F.lit("NumRecordsInSource").alias("FirstRecordMeasureTitle"), F.col("event_id").alias("FirstRecordMeasureValue"),
        F.lit("NumRecordsInTarget").alias("SecondRecordMeasureTitle"), F.col("user_id").alias("SecondRecordMeasureValue"),
        F.col("ts").alias("__CreatedOn"),
    )
    return quality.latest_measures(log)
