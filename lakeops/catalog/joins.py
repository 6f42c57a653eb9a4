"""J: joins."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.operators import joins, matrix


@query("j1_inner_detail", """
    SELECT l_orderkey, l_linenumber, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def inner_detail(t):
    detail = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber")
    return joins.inner_detail(rows, detail, ["l_suppkey"]).drop("l_suppkey")


@query("j2_code_lookup", """
    SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'""")
def code_lookup(t):
    codes = t.customer.withColumnRenamed("c_custkey", "o_custkey").select("o_custkey", "c_name", "c_mktsegment")
    rows = t.orders.select("o_orderkey", "o_custkey")
    return joins.code_lookup(rows, codes, ["o_custkey"], F.col("c_mktsegment") == "BUILDING").select("o_orderkey", "c_name")


@query("j3_current_version", """
    SELECT o_orderkey, c_name FROM orders
    LEFT JOIN (SELECT c_custkey, c_name, c_acctbal >= 0 AS CurrInd FROM customer) d
      ON o_custkey = c_custkey AND d.CurrInd = TRUE""")
def current_version(t):
    versions = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), "c_name", (F.col("c_acctbal") >= 0).alias("CurrInd")
    )
    return joins.current_version(t.orders.select("o_orderkey", "o_custkey"), versions, ["o_custkey"]).drop("o_custkey")


REDUCED = "(SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING')"


def reduced(t):
    return t.customer.where(F.col("c_mktsegment") != "BUILDING")


@query("j4_unknown_keys", f"""
    SELECT DISTINCT o_custkey FROM orders LEFT JOIN {REDUCED} d ON o_custkey = c_custkey WHERE c_custkey IS NULL""")
def unknown_keys(t):
    return joins.unknown_keys(t.orders, reduced(t), "o_custkey", "c_custkey")


@query("j5_not_yet_loaded", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem u WHERE NOT EXISTS (
      SELECT 1 FROM lineitem v WHERE v.l_returnflag = 'R'
        AND v.l_orderkey = u.l_orderkey AND v.l_linenumber = u.l_linenumber)""")
def not_yet_loaded(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.not_yet_loaded(rows, t.lineitem.where("l_returnflag = 'R'"), ["l_orderkey", "l_linenumber"])


@query("j6_of_batch_dates", """
    WITH target AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d FROM orders)
    SELECT o_orderkey, d FROM target
    WHERE d IN (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders WHERE o_totalprice > 450000) OR d IS NULL""")
def of_batch_dates(t):
    day = F.col("o_orderdate").cast("date")
    target = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", day).alias("d"))
    batch = t.orders.where("o_totalprice > 450000").select(day.alias("d"))
    return joins.of_batch_dates(target, batch, "d").select("o_orderkey", "d")


@query("j7_code_to_name", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status_name FROM orders""")
def code_to_name(t):
    names = F.create_map(F.lit("F"), F.lit("finished"), F.lit("O"), F.lit("open"))
    return t.orders.select("o_orderkey", F.try_element_at(names, F.col("o_orderstatus")).alias("status_name"))


@query("j8_weighted_totals", """
    SELECT CAST(l_shipdate AS DATE) AS day, round(sum(l_quantity * p_retailprice), 2) AS total
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def weighted_totals(t):
    sold = t.lineitem.select(F.col("l_shipdate").cast("date").alias("day"), F.col("l_partkey").alias("p_partkey"), "l_quantity")
    totals = joins.weighted_totals(sold, t.part, "day", "p_partkey", "l_quantity", "p_retailprice")
    return totals.withColumn("total", F.round("total", 2))


@query("j9_matrix_product", """
    WITH a AS (SELECT l_returnflag AS i, l_orderkey AS k, sum(l_quantity) AS x FROM lineitem GROUP BY ALL),
         b AS (SELECT l_orderkey AS k, l_linenumber AS j, sum(l_extendedprice) AS y FROM lineitem GROUP BY ALL)
    SELECT i, j, round(sum(x * y), 2) AS v FROM a JOIN b USING (k) GROUP BY i, j""")
def matrix_product(t):
    a = t.lineitem.select(F.col("l_returnflag").alias("i"), F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("v"))
    b = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("j"), F.col("l_extendedprice").alias("v"))
    return matrix.matrix_product(a, b).withColumn("v", F.round("v", 2))


@query("j10_value_grid", """
    WITH e AS (SELECT min(o_totalprice) AS xl, max(o_totalprice) AS xh,
                      CAST(min(o_custkey) AS DOUBLE) AS yl, CAST(max(o_custkey) AS DOUBLE) AS yh FROM orders)
    SELECT CAST(a.i AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j, round(xl + (xh - xl) * a.i / 100.0, 4) AS o_totalprice,
           round(yl + (yh - yl) * b.j / 100.0, 4) AS o_custkey
    FROM e, range(0, 101) a(i), range(0, 101) b(j)""")
def value_grid(t):
    grid = joins.value_grid(t.orders, "o_totalprice", "o_custkey", 101)
    return grid.withColumns({c: F.round(c, 4) for c in ("o_totalprice", "o_custkey")})
