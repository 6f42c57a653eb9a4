"""P: projections, filters and row shaping."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.operators import shape
from lakeops.operators.ordering import add_row_index


@query("p1_rename_trim", """
    SELECT p_partkey AS PartKey, trim(p_name) AS PartName, trim(p_type) AS PartType FROM part""")
def rename_trim(t):
    return shape.rename_trim(t.part, {"p_partkey": "PartKey", "p_name": "PartName", "p_type": "PartType"})


@query("p2_rename_nested", """
    SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders""")
def rename_nested(t):
    nested = t.orders.select("o_orderkey", F.struct("o_orderstatus", F.array("o_orderpriority")).alias("s"))
    named = nested.withColumn("s", F.col("s").cast("struct<Status:string,Priorities:array<string>>"))
    return named.select("o_orderkey", F.col("s.Status").alias("status"), F.col("s.Priorities")[0].alias("priority"))


@query("p3_cast", """
    SELECT p_partkey, CAST(p_partkey AS INTEGER) AS part_id, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no,
           TRY_CAST(p_name AS INTEGER) AS no_number FROM part""")
def cast(t):
    return t.part.select(
        "p_partkey",
        F.col("p_partkey").cast("int").alias("part_id"),
        F.substring("p_brand", 7, 10).try_cast("int").alias("brand_no"),
        F.col("p_name").try_cast("int").alias("no_number"),
    )


@query("p4_audit_columns", """
    SELECT o_orderkey, TIMESTAMP '2024-01-01 00:00:00' AS window_start, TIMESTAMP '2024-01-02 00:00:00' AS window_end,
           TIMESTAMP '2024-01-03 04:05:06' AS created_on, TIMESTAMP '2024-01-03 04:05:06' AS updated_on FROM orders""")
def audit_columns(t):
    def at(text):
        return F.lit(text).cast("timestamp_ntz")
    stamped = shape.add_audit_columns(
        t.orders.select("o_orderkey"), at("2024-01-01 00:00:00"), at("2024-01-02 00:00:00"), at("2024-01-03 04:05:06")
    )
    return stamped.withColumnsRenamed({
        "__WindowStartTime": "window_start", "__WindowEndTime": "window_end",
        "__CreatedOn": "created_on", "__UpdatedOn": "updated_on",
    })


@query("p5_arithmetic_column", """
    SELECT l_orderkey, l_linenumber, l_quantity, round(l_extendedprice / 1.6::DOUBLE, 6) AS miles,
           round(l_quantity / 100 * l_extendedprice, 6) AS used FROM lineitem""")
def arithmetic_column(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.round(F.col("l_extendedprice") / F.lit(1.6), 6).alias("miles"),
        F.round(F.col("l_quantity") / F.lit(100.0) * F.col("l_extendedprice"), 6).alias("used"),
    )


@query("p6_constant_column", "SELECT c_custkey, 4 AS wheels FROM customer")
def constant_column(t):
    return t.customer.select("c_custkey").withColumn("wheels", F.lit(4))


@query("p7_drop_column", "SELECT n_nationkey, n_regionkey FROM nation")
def drop_column(t):
    return t.nation.drop("n_name")


@query("p8_date_window", """
    SELECT event_id, user_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17'""")
def date_window(t):
    return shape.date_window(t.events, "ts", "2024-01-10", "2024-01-17").select("event_id", "user_id", "event_type")


@query("p8_date_window_one_day", """
    SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'""")
def date_window_one_day(t):
    return shape.date_window(t.events, "ts", "2024-01-10").select("event_id")


@query("p9_comparison_filter", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity > 25 AND l_linestatus <> 'F'""")
def comparison_filter(t):
    c = F.col
    kept = (c("l_returnflag") == "R") & (c("l_quantity") > 25) & (c("l_linestatus") != "F")
    return t.lineitem.where(kept).select("l_orderkey", "l_linenumber", "l_quantity")


@query("p11_pattern_filter", """
    SELECT page_id, url FROM pages WHERE regexp_matches(url, 'm.th') OR regexp_matches(url, 'page=[0-9]+')""")
def pattern_filter(t):
    return t.pages.where(shape.any_pattern("url", ["m.th", "page=[0-9]+"])).select("page_id", "url")


NULLED = """(SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
             CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS value FROM events)"""


def nulled(t):
    kind = F.col("event_type")
    return t.events.select(
        "event_id",
        F.when(kind != "error", F.col("user_id")).alias("user_id"),
        F.when(~kind.isin("error", "view"), F.col("value")).alias("value"),
    )


@query("p12_drop_empty_rows", f"""
    SELECT user_id, value FROM {NULLED} WHERE user_id IS NOT NULL OR value IS NOT NULL""")
def drop_empty_rows(t):
    return nulled(t).drop("event_id").dropna(how="all")


@query("p13_drop_null_rows", f"SELECT event_id, user_id, value FROM {NULLED} WHERE user_id IS NOT NULL AND value IS NOT NULL")
def drop_null_rows(t):
    return nulled(t).dropna()


@query("p13_drop_null_subset", f"SELECT event_id, user_id, value FROM {NULLED} WHERE user_id IS NOT NULL")
def drop_null_subset(t):
    return nulled(t).dropna(subset=["user_id"])


@query("p14_replace_values", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END
           AS o_orderstatus FROM orders""")
def replace_values(t):
    return t.orders.select("o_orderkey", "o_orderstatus").replace({"F": "Finished", "O": "Open"}, subset=["o_orderstatus"])


@query("p15_conditional_overwrite", """
    SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'big' ELSE o_orderpriority END AS o_orderpriority
    FROM orders""")
def conditional_overwrite(t):
    chosen = F.when(F.col("o_totalprice") > 300000, "big").otherwise(F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", chosen.alias("o_orderpriority"))


@query("p16_align_columns", """
    SELECT s_nationkey, s_suppkey, FALSE AS s_flag FROM supplier""")
def align_columns(t):
    return shape.align_columns(t.supplier, ["s_nationkey", "s_suppkey", "s_flag"])


@query("p17_columns_by_type", """
    SELECT CAST(sum(c_custkey) AS DOUBLE) AS c_custkey, CAST(sum(c_nationkey) AS DOUBLE) AS c_nationkey,
           round(sum(c_acctbal), 2) AS c_acctbal FROM customer""")
def columns_by_type(t):
    numeric = shape.columns_of(t.customer, "numeric")
    return t.customer.agg(*[F.round(F.sum(F.col(c).cast("double")), 2).alias(c) for c in numeric])


@query("p18_row_index", """
    SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS row_index FROM customer""")
def row_index(t):
    return add_row_index(t.customer.select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), "c_custkey"]).drop("c_acctbal")


@query("p19_feature_label_split", "SELECT quality FROM labels")
def feature_label_split(t):
    return shape.features_and_label(t.labels, "quality")[1]


@query("p20_attach_series", """
    WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS i FROM customer),
         b AS (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier)
    SELECT c_custkey, s_name FROM a LEFT JOIN b USING (i)""")
def attach_series(t):
    return shape.attach_series(t.customer.select("c_custkey"), ["c_custkey"], t.supplier, ["s_suppkey"], "s_name")


@query("p20_attach_list", """
    WITH a AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) AS i FROM nation)
    SELECT n_name, CASE i WHEN 1 THEN 7.5 WHEN 2 THEN 9.2 WHEN 3 THEN 5.0 END::DOUBLE AS fuel FROM a""")
def attach_list(t):
    return shape.attach_by_position(t.nation.select("n_nationkey", "n_name"), ["n_nationkey"], [7.5, 9.2, 5.0], "fuel").drop("n_nationkey")
