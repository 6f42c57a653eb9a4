"""R1 to R4: report tables."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.plans import reports

ACTIVITIES = """(SELECT o_orderkey, trim(o_orderpriority) AS code, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS baseline,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS finish,
    CASE WHEN o_orderstatus = 'F' THEN 'Completed' ELSE 'Not Started' END AS status FROM orders)"""


def activities(t):
    """Orders as activities: priority is the code, the month the snapshot."""
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey", F.concat(F.lit(" "), "o_orderpriority").alias("code"), F.trunc("o_orderdate", "month").alias("snapshot"),
        F.when(F.col("o_orderstatus") != "P", day).alias("baseline"),
        F.date_add(day, (F.col("o_orderkey") % 20).cast("int")).alias("finish"),
        F.when(F.col("o_orderstatus") == "F", "Completed").otherwise("Not Started").alias("status"),
    )


@query("r1_milestone_variance", f"""
    WITH a AS (SELECT * REPLACE (coalesce(baseline, finish) AS baseline) FROM {ACTIVITIES} WHERE regexp_matches(code, '[1-4].[A-Z]')),
         v AS (SELECT *, date_diff('day', baseline, finish) AS days, dense_rank() OVER (ORDER BY snapshot) - 1 AS c1,
                      dense_rank() OVER (ORDER BY snapshot DESC) AS c2, max(snapshot) OVER () = snapshot AS is_current FROM a),
         o AS (SELECT *, row_number() OVER (PARTITION BY code, snapshot ORDER BY baseline DESC, o_orderkey) AS rn FROM v)
    SELECT code, snapshot, o_orderkey, baseline, finish, days AS variance_days, c1 AS "ordinal", c2 AS "reverse_ordinal", is_current,
           CASE WHEN status = 'Completed' THEN 'Blue' WHEN days <= 7 THEN 'Green' WHEN days < 14 THEN 'Amber' ELSE 'Red' END AS rag
    FROM o WHERE rn = 1""")
def milestone_variance(t):
    rows = reports.milestone_variance(
        activities(t), "code", "snapshot", "baseline", "finish", "status", tie=-F.col("o_orderkey"), pattern="[1-4].[A-Z]"
    )
    return rows.select(
        "code", "snapshot", "o_orderkey", "baseline", "finish", F.col("variance_days").cast("bigint").alias("variance_days"),
        "ordinal", "reverse_ordinal", "is_current", "rag",
    )


@query("r2_milestone_tracker", """
    WITH p AS (SELECT o_orderpriority AS programme, 'Customer ' || o_custkey || repeat(' milestone', CAST(o_custkey % 12 AS INTEGER)) AS name,
                      o_orderkey, CAST(o_orderdate AS DATE) AS base, CAST(o_orderdate AS DATE) + 40 AS fc,
                      CASE WHEN o_orderstatus = 'F' THEN 'Complete' ELSE 'Red' END AS status,
                      CASE o_orderstatus WHEN 'F' THEN 'Green' WHEN 'O' THEN 'Red' ELSE 'Amber' END AS trend FROM orders),
         e AS (SELECT *, row_number() OVER (PARTITION BY programme, name ORDER BY base, o_orderkey) AS rn,
                      min(o_orderkey) OVER (PARTITION BY programme) AS seen FROM p)
    SELECT row_number() OVER (ORDER BY seen, programme, base, name) AS slot, programme, name,
           CASE WHEN length(name) > 100 THEN substr(name, 1, 97) || '...' ELSE name END AS label,
           strftime(base, '%b %Y') AS baseline_label, strftime(fc, '%b %Y') AS forecast_label,
           CASE WHEN status = 'Complete' THEN 'Blue' ELSE status END AS status_colour,
           CASE trend WHEN 'Green' THEN 'larrow' WHEN 'Red' THEN 'rarrow' ELSE 'darrow' END AS arrow,
           CASE WHEN trend = 'Amber' THEN '#ff7f0e' ELSE trend END AS trend_colour
    FROM e WHERE rn = 1""")
def milestone_tracker(t):
    day = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    name = F.concat(F.lit("Customer "), "o_custkey", F.repeat(F.lit(" milestone"), (F.col("o_custkey") % 12).cast("int")))
    rows = t.orders.select(
        F.col("o_orderpriority").alias("programme"), name.alias("name"), day.alias("base"), F.date_add(day, 40).alias("fc"),
        F.when(status == "F", "Complete").otherwise("Red").alias("status"),
        F.when(status == "F", "Green").when(status == "O", "Red").otherwise("Amber").alias("trend"), "o_orderkey",
    )
    return reports.milestone_tracker(rows, "programme", "name", "base", "fc", "status", "trend", "o_orderkey")


@query("r3_daily_totals", """
    SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS quantity, round(sum(l_quantity * p_retailprice), 2) AS total
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def daily_totals(t):
    sold = t.lineitem.select(F.col("l_shipdate").cast("date").alias("day"), F.col("l_partkey").alias("p_partkey"), "l_quantity")
    rows = reports.daily_totals(sold, t.part, "day", "p_partkey", "l_quantity", "p_retailprice")
    return rows.withColumn("total", F.round("total", 2))


@query("r4_milestone_axis", f"""
    WITH d AS (SELECT baseline AS d FROM {ACTIVITIES} UNION ALL SELECT finish FROM {ACTIVITIES} WHERE finish IS DISTINCT FROM baseline),
         e AS (SELECT min(d) AS f, max(d) AS l, CAST(min(d) - INTERVAL 1 MONTH AS DATE) AS a, CAST(max(d) + INTERVAL 1 MONTH AS DATE) AS b FROM d)
    SELECT CAST(m AS DATE) AS month_start, year(m) AS year, strftime(m, '%b') AS month, f AS first, l AS last FROM (
      SELECT unnest(generate_series(date_trunc('month', a)::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 MONTH)) AS m, a, f, l FROM e) WHERE m >= a""")
def milestone_axis(t):
    axis = reports.milestone_axis(activities(t), "baseline", "finish")
    return axis.withColumn("year", F.col("year").cast("bigint"))
