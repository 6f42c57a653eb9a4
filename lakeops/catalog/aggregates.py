"""A: aggregations."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.operators import correlation, profile
from lakeops.operators.ordering import add_row_index
from lakeops.operators.ranking import top_per


@query("a1_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def shape_of(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(t.lineitem.columns)).cast("bigint").alias("n_columns"))


@query("a2_distinct_tuples", """
    SELECT count(DISTINCT (l_partkey, l_suppkey)) AS n, count(DISTINCT (a, b)) AS n_with_nulls FROM (
      SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS a,
                CASE WHEN l_linestatus <> 'O' THEN l_tax END AS b FROM lineitem)""")
def distinct_tuples(t):
    rows = t.lineitem.withColumns({
        "a": F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")),
        "b": F.when(F.col("l_linestatus") != "O", F.col("l_tax")),
    })
    # two plain distinct counts instead of one aggregate that would expand every row
    pairs = rows.select("l_partkey", "l_suppkey").distinct().agg(F.count(F.lit(1)).alias("n"))
    nulls = rows.select("a", "b").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return pairs.withColumn("n_with_nulls", nulls)


@query("a3_group_having", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def group_having(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def rounded(df, digits=4):
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


@query("a4_group_means", """
    SELECT c_mktsegment, round(avg(c_custkey), 4) AS c_custkey_mean, round(avg(c_nationkey), 4) AS c_nationkey_mean,
           round(avg(c_acctbal), 4) AS c_acctbal_mean FROM customer GROUP BY 1""")
def group_means(t):
    return rounded(profile.numeric_means(t.customer, ["c_mktsegment"]))


@query("a5_column_sums_means", """
    SELECT round(avg(l_quantity), 4) AS l_quantity_mean, round(avg(l_extendedprice), 4) AS l_extendedprice_mean,
           round(sum(l_quantity), 2) AS l_quantity_sum, round(sum(l_extendedprice), 2) AS l_extendedprice_sum FROM lineitem""")
def column_sums_means(t):
    columns = ["l_quantity", "l_extendedprice"]
    return t.lineitem.agg(
        *[F.round(F.avg(c), 4).alias(f"{c}_mean") for c in columns],
        *[F.round(F.sum(c), 2).alias(f"{c}_sum") for c in columns],
    )


def _describe_sql(column):
    return f"""SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}), 4) AS mean,
        round(stddev_samp({column}), 4) AS std, CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max,
        round(quantile_cont({column}, 0.25), 4) AS q25, round(quantile_cont({column}, 0.5), 4) AS q50,
        round(quantile_cont({column}, 0.75), 4) AS q75 FROM orders"""


@query("a6_describe", " UNION ALL ".join(_describe_sql(c) for c in ("o_totalprice", "o_custkey")))
def describe(t):
    return rounded(profile.describe(t.orders, ["o_totalprice", "o_custkey"]))


def _profile_sql(column, kind, present):
    return f"""SELECT '{column}' AS "column", '{kind}' AS "type", count({present}) AS non_null,
        count(*) - count({present}) AS nulls, round((count(*) - count({present})) / count(*), 4) AS null_ratio FROM orders"""


@query("a7_column_profile", " UNION ALL ".join([
    _profile_sql("o_orderkey", "bigint", "o_orderkey"),
    _profile_sql("o_orderdate", "timestamp_ntz", "o_orderdate"),
    _profile_sql("urgent", "string", "CASE WHEN o_orderpriority = '1-URGENT' THEN 'y' END"),
]))
def column_profile(t):
    rows = t.orders.select("o_orderkey", "o_orderdate", F.when(F.col("o_orderpriority") == "1-URGENT", "y").alias("urgent"))
    return rounded(profile.column_profile(rows))


@query("a8_value_counts", """
    SELECT o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1""")
def value_counts(t):
    return rounded(profile.value_counts(t.orders, "o_orderpriority"), 6)


@query("a9_crosstab", """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
           count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def crosstab(t):
    return profile.crosstab(t.orders, "o_orderpriority", "o_orderstatus")


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a10_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in MEASURES for b in MEASURES
))
def correlations(t):
    return rounded(correlation.correlations(t.lineitem, MEASURES), 6)


@query("a11_median", """
    SELECT round(median(l_extendedprice), 4) AS median_price, round(avg(l_extendedprice), 4) AS mean_price,
           round((sum(l_extendedprice) + 1e9) / (count(*) + 1), 4) AS mean_with_outlier FROM lineitem""")
def median(t):
    middle = profile.exact_quantiles(t.lineitem, ["l_extendedprice"], [0.5])["l_extendedprice"][0.5]
    price = F.col("l_extendedprice")
    return rounded(t.lineitem.agg(
        F.lit(middle).alias("median_price"),
        F.avg(price).alias("mean_price"),
        ((F.sum(price) + F.lit(1e9)) / (F.count(price) + 1)).alias("mean_with_outlier"),
    ))


@query("a12_group_maximum_row", """
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def group_maximum_row(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return top_per(rows, ["o_custkey"], "o_totalprice", -F.col("o_orderkey"))


@query("a13_min_max", """
    SELECT label, min(x) AS low, max(x) AS high FROM (SELECT label, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY 1
    UNION ALL SELECT -1, min(x), max(x) FROM (SELECT unnest(embedding)::DOUBLE AS x FROM embeddings)""")
def min_max(t):
    rows = t.embeddings.select(
        "label", F.array_min("embedding").cast("double").alias("low"), F.array_max("embedding").cast("double").alias("high")
    )
    ends = [F.min("low").alias("low"), F.max("high").alias("high")]
    return rows.groupBy("label").agg(*ends).unionByName(
        rows.agg(*ends).withColumn("label", F.lit(-1).cast(dict(t.embeddings.dtypes)["label"]))
    )


@query("a14_population_deviation", """
    SELECT l_returnflag, round(stddev_pop(l_extendedprice), 4) AS std, round(var_pop(l_quantity), 4) AS var
    FROM lineitem GROUP BY 1""")
def population_deviation(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.stddev_pop("l_extendedprice"), 4).alias("std"), F.round(F.var_pop("l_quantity"), 4).alias("var")
    )


@query("a15_distinct_values", """
    SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) AS in_order,
           row_number() OVER (ORDER BY min(o_orderkey)) AS in_appearance FROM orders GROUP BY 1""")
def distinct_values(t):
    values = t.orders.groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("first"))
    sorted_ = add_row_index(values, ["o_orderpriority"], "in_order", start=1)
    return add_row_index(sorted_, ["first"], "in_appearance", start=1).drop("first")


@query("a16_histogram", """
    WITH e AS (SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders)
    SELECT least(floor((o_totalprice - low) / ((high - low) / 7.0)), 6)::BIGINT AS bin, count(*) AS n FROM orders, e GROUP BY 1""")
def histogram(t):
    return profile.histogram(t.orders, "o_totalprice", 7)


RUNS = """(SELECT event_type AS run, day(ts) AS epoch, avg(value) AS metric FROM events GROUP BY 1, 2)"""


def runs(t):
    return t.events.groupBy(F.col("event_type").alias("run"), F.dayofmonth("ts").cast("bigint").alias("epoch")).agg(
        F.avg("value").alias("metric")
    )


@query("a17_mean_over_runs", f"SELECT epoch, round(avg(metric), 7) AS metric FROM {RUNS} GROUP BY 1")
def mean_over_runs(t):
    return runs(t).groupBy("epoch").agg(F.round(F.avg("metric"), 7).alias("metric"))


@query("a18_group_ratio", """
    SELECT round(avg(l_quantity) FILTER (l_linestatus = 'O') / avg(l_quantity) FILTER (l_linestatus = 'F'), 6) AS l_quantity_ratio,
           round(avg(l_tax) FILTER (l_linestatus = 'O') / avg(l_tax) FILTER (l_linestatus = 'F'), 6) AS l_tax_ratio FROM lineitem""")
def group_ratio(t):
    return rounded(profile.ratio_of(t.lineitem, "l_linestatus", "O", "F", ["l_quantity", "l_tax"]), 6)


@query("a19_percent_difference", """
    WITH m AS (SELECT avg(l_extendedprice) FILTER (l_returnflag = 'A') AS a, avg(l_extendedprice) FILTER (l_returnflag = 'R') AS b FROM lineitem)
    SELECT round(a, 4) AS mean_a, round(b, 4) AS mean_b, round((b - a) / a * 100, 6) AS percent_difference FROM m""")
def percent_difference(t):
    found = profile.group_difference(t.lineitem, "l_returnflag", "A", "R", "l_extendedprice")
    return found.select(F.round("mean_a", 4).alias("mean_a"), F.round("mean_b", 4).alias("mean_b"),
                        F.round("percent_difference", 6).alias("percent_difference"))


@query("a23_distinct_size", "SELECT count(DISTINCT o_custkey) AS n FROM orders")
def distinct_size(t):
    return t.orders.agg(F.countDistinct("o_custkey").alias("n"))
