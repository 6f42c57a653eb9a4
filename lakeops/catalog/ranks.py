"""W and T: window forms, sorting, top rows and samples."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.operators import ranking
from lakeops.operators.ordering import add_row_index

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


@query("w1_latest_version", f"""
    SELECT {', '.join(LINE)} FROM (SELECT *, dense_rank() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC) AS r FROM lineitem) WHERE r = 1""")
def latest_version(t):
    return ranking.latest_per_key(t.lineitem.select(LINE), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query("w2_latest_partition", """
    SELECT event_id, user_id, d FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS d, dense_rank() OVER (
        PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) AS r FROM events) WHERE r = 1""")
def latest_partition(t):
    rows = t.events.select("event_id", "user_id", F.col("ts").cast("date").alias("d"))
    return ranking.latest_per_key(rows, ["user_id"], "d")


@query("w3_global_numbering", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders")
def global_numbering(t):
    return add_row_index(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "n", start=1).drop("o_orderdate")


@query("w4_group_ordinals", """
    WITH m AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders)
    SELECT o_orderkey, d, dense_rank() OVER (ORDER BY d) - 1 AS "ordinal", dense_rank() OVER (ORDER BY d DESC) AS "reverse_ordinal" FROM m""")
def group_ordinals(t):
    rows = t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("d"))
    return ranking.group_ordinals(rows, "d")


@query("w5_cumulative_sum", """
    SELECT d, round(sum(s) OVER (ORDER BY d), 2) AS running FROM (
      SELECT CAST(o_orderdate AS DATE) AS d, sum(o_totalprice) AS s FROM orders GROUP BY 1)""")
def cumulative_sum(t):
    rows = t.orders.select(F.col("o_orderdate").cast("date").alias("d"), "o_totalprice")
    return ranking.cumulative_by(rows, "d", "o_totalprice", "running").select("d", F.round("running", 2).alias("running"))


@query("w6_slots", """
    SELECT o_orderkey, row_number() OVER (ORDER BY f, o_orderpriority, o_orderdate, o_orderkey) AS slot FROM (
      SELECT *, min(o_orderkey) OVER (PARTITION BY o_orderpriority) AS f FROM orders)""")
def slots(t):
    rows = t.orders.select("o_orderpriority", "o_orderdate", "o_orderkey")
    return ranking.slots(rows, "o_orderpriority", "o_orderkey", "o_orderdate", "o_orderkey").select("o_orderkey", "slot")


@query("w7_current_snapshot", """
    SELECT o_orderkey, date_trunc('month', o_orderdate) = max(date_trunc('month', o_orderdate)) OVER () AS is_current FROM orders""")
def current_snapshot(t):
    rows = t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("d"))
    return ranking.current_and_earlier(rows, "d").drop("d")


@query("t1_sort", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber")
def sort(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").orderBy("l_shipdate", "l_orderkey", "l_linenumber")


@query("t2_first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def first_rows(t):
    return ranking.first_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query("t2_last_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def last_rows(t):
    return ranking.last_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query("t3_most_wrong", """
    SELECT doc_id, quality, score FROM (SELECT doc_id, quality, ((doc_id * 37) % 101) / 101.0::DOUBLE AS score FROM labels)
    WHERE (score >= 0.5) <> (quality = 1) ORDER BY score DESC, doc_id LIMIT 10""")
def most_wrong(t):
    scored = t.labels.select("doc_id", "quality", ((F.col("doc_id") * 37 % 101) / F.lit(101.0)).alias("score"))
    wrong = scored.where((F.col("score") >= 0.5) != (F.col("quality") == 1))
    return ranking.first_rows(wrong, [F.desc("score"), "doc_id"], 10)


@query("t6_sample_fraction", "SELECT o_orderkey FROM orders WHERE md5('42:' || o_orderkey) < '33333333'")
def sample_fraction(t):
    return ranking.sample_fraction(t.orders.select("o_orderkey"), ["o_orderkey"], 0.2, 42)


@query("t6_shuffle", "SELECT event_id, user_id FROM events ORDER BY md5('7:' || event_id)")
def shuffle(t):
    return ranking.shuffled(t.events.select("event_id", "user_id"), ["event_id"], 7)


@query("t7_sample_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 9")
def sample_rows(t):
    return ranking.sample_rows(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], 9, 42)
