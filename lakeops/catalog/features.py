"""F: feature preparation."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.durable import fresh_path
from lakeops.ml import features, models, prepare
from lakeops.operators.text import word_counts

# prices of urgent orders and the status of low-priority ones are taken as missing
GAPS = """(SELECT o_orderkey, o_orderdate, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS status FROM orders)"""


def gaps(t):
    p = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", "o_orderdate", F.when(p != "1-URGENT", F.col("o_totalprice")).alias("price"),
        F.when(p != "5-LOW", F.col("o_orderstatus")).alias("status"),
    )


@query("f1_median_fill", f"""
    SELECT o_orderkey, price IS NULL AS price_is_missing, round(coalesce(price, (SELECT median(price) FROM {GAPS})), 4) AS price FROM {GAPS}""")
def median_fill(t):
    rows = gaps(t).select("o_orderkey", "price")
    columns = features.with_nulls(rows, ["price"])
    return features.fill_numeric(rows, features.medians(rows, columns)).withColumn("price", F.round("price", 4))


@query("f2_category_codes", f"""
    WITH d AS (SELECT status, row_number() OVER (ORDER BY status) AS code FROM (SELECT DISTINCT status FROM {GAPS} WHERE status IS NOT NULL))
    SELECT o_orderkey, g.status IS NULL AS status_is_missing, coalesce(code, 0) AS status FROM {GAPS} g LEFT JOIN d USING (status)""")
def category_codes(t):
    rows = gaps(t).select("o_orderkey", "status")
    return features.apply_codes(rows, features.category_dictionary(rows, ["status"]), ["status"])


@query("f3_ordinal_codes", """
    WITH d AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code FROM (
      SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '3-MEDIUM'))
    SELECT o_orderkey, coalesce(code, -1)::DOUBLE AS code FROM orders LEFT JOIN d USING (o_orderpriority)""")
def ordinal_codes(t):
    # the training rows lack one priority, which is then unseen
    train = t.orders.where(F.col("o_orderpriority") != "3-MEDIUM")
    encode = features.ordinal_codes(train, ["o_orderpriority"])
    return encode(t.orders).select("o_orderkey", F.col("o_orderpriority_code").alias("code"))


@query("f4_one_hot", """
    SELECT o_orderkey, (o_orderstatus = 'F')::INT::DOUBLE AS f, (o_orderstatus = 'O')::INT::DOUBLE AS o, o_totalprice AS price FROM orders""")
def one_hot(t):
    transform = features.one_hot(t.orders.where(F.col("o_orderstatus") != "P"), ["o_orderstatus"], ["o_totalprice"])
    values = vector_to_array("features")
    return transform(t.orders).select("o_orderkey", values[0].alias("f"), values[1].alias("o"), values[2].alias("price"))


@query("f5_dummy_columns", """
    SELECT c_custkey, c_mktsegment = 'AUTOMOBILE' AS c_mktsegment_AUTOMOBILE, c_mktsegment = 'BUILDING' AS c_mktsegment_BUILDING,
           c_mktsegment = 'FURNITURE' AS c_mktsegment_FURNITURE, c_mktsegment = 'HOUSEHOLD' AS c_mktsegment_HOUSEHOLD,
           c_mktsegment = 'MACHINERY' AS c_mktsegment_MACHINERY FROM customer""")
def dummy_columns(t):
    return features.dummy_columns(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query("f6_impute", f"""
    SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM {GAPS})), 4) AS mean_price,
           round(coalesce(price, (SELECT median(price) FROM {GAPS})), 4) AS median_price, coalesce(status, 'missing') AS status FROM {GAPS}""")
def impute(t):
    rows = gaps(t).select("o_orderkey", F.col("price").alias("mean_price"), F.col("price").alias("median_price"), "status")
    filled = features.impute(rows, {"status": "missing"}, ["mean_price"], ["median_price"])
    return filled.withColumns({c: F.round(c, 4) for c in ("mean_price", "median_price")})


@query("f7_chained_preparation", """
    SELECT l_orderkey, l_linenumber, round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS quantity,
           round(l_discount / (SELECT stddev_samp(l_discount) FROM lineitem), 6) AS discount FROM lineitem""")
def chained_preparation(t):
    stages = features.one_hot_stages(["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount"], "raw")
    scaled = StandardScaler(inputCol="raw", outputCol="features", withMean=False)
    chain = Pipeline(stages=[features.imputer_stage(["l_quantity"]), *stages, scaled])
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    # each value over the sample deviation of its column; the passed columns come last
    scaled = vector_to_array("features")
    return chain.fit(rows).transform(rows).select(
        "l_orderkey", "l_linenumber", F.round(F.element_at(scaled, -2), 6).alias("quantity"), F.round(F.element_at(scaled, -1), 6).alias("discount"),
    )


# medians, codes and a line through the filled values, fitted as one object, written and read again
@query("f7_saved_chain", f"""
    WITH g AS (SELECT o_orderkey, o_totalprice, price IS NULL AS price_is_missing, status, year(o_orderdate) AS o_orderdateYear,
                      coalesce(price, (SELECT median(price) FROM {GAPS})) AS x FROM {GAPS} JOIN (SELECT o_orderkey, o_totalprice FROM orders) USING (o_orderkey)),
         f AS (SELECT regr_slope(o_totalprice, x) AS a, regr_intercept(o_totalprice, x) AS b FROM g),
         d AS (SELECT status, row_number() OVER (ORDER BY status) AS code FROM (SELECT DISTINCT status FROM g WHERE status IS NOT NULL))
    SELECT o_orderkey, price_is_missing, coalesce(code, 0) AS status, o_orderdateYear, round(a * x + b, 2) AS prediction FROM g LEFT JOIN d USING (status), f""")
def saved_chain(t):
    rows = gaps(t).join(t.orders.select("o_orderkey", F.col("o_totalprice").alias("label")), "o_orderkey")
    chain = Pipeline(stages=[
        prepare.Prepare(numeric=["price"], categories=["status"], date="o_orderdate"),
        VectorAssembler(inputCols=["price"], outputCol="features"), LinearRegression(solver="normal"),
    ])
    path = fresh_path(t.spark, "chain")
    models.save_model(chain.fit(rows), path)
    return models.load_chain(path).transform(rows).select(
        "o_orderkey", "price_is_missing", "status", F.col("o_orderdateYear").cast("bigint").alias("o_orderdateYear"),
        F.round("prediction", 2).alias("prediction"),
    )


@query("f8_date_features", """
    SELECT o_orderkey, year(o_orderdate) AS saleYear, month(o_orderdate) AS saleMonth, day(o_orderdate) AS saleDay,
           isodow(o_orderdate) - 1 AS saleDayofweek, dayofyear(o_orderdate) AS saleDayofyear FROM orders""")
def date_features(t):
    rows = features.expand_date(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "sale")
    return rows.select(*[F.col(c).cast("bigint").alias(c) for c in rows.columns])


@query("f9_random_split", """
    SELECT o_orderkey, CASE WHEN md5('42:' || o_orderkey) < 'b3333333' THEN 'train' WHEN md5('42:' || o_orderkey) < 'd9999999' THEN 'valid' ELSE 'test' END AS part FROM orders""")
def random_split(t):
    part = features.hashed_split(["o_orderkey"], {"train": 0.7, "valid": 0.15, "test": 0.15}, 42)
    return t.orders.select("o_orderkey", part.alias("part"))


@query("f10_split_by_year", """
    SELECT o_orderkey, CASE WHEN year(o_orderdate) = 2000 THEN 'valid' ELSE 'train' END AS part FROM orders""")
def split_by_year(t):
    return t.orders.select("o_orderkey", F.when(F.year("o_orderdate") == 2000, "valid").otherwise("train").alias("part"))


@query("f11_ordered_split", """
    SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS part FROM orders""")
def ordered_split(t):
    return features.ordered_split(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], 0.8).drop("o_orderdate")


@query("f12_word_split", r"""
    SELECT DISTINCT word, CASE WHEN md5('42:' || word) < 'cccccccc' THEN 'train' WHEN md5('42:' || word) < 'e6666666' THEN 'dev' ELSE 'test' END AS part
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word FROM documents) WHERE word <> ''""")
def word_split(t):
    part = features.hashed_split(["word"], {"train": 0.8, "dev": 0.1, "test": 0.1}, 42)
    return word_counts(t.documents, "text").select("word", part.alias("part"))


@query("f13_seeded_split", """
    SELECT event_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || event_id), event_id) <= floor(0.2 * count(*) OVER ()) THEN 'part' ELSE 'rest' END AS part FROM events""")
def seeded_split(t):
    return features.seeded_split(t.events.select("event_id"), ["event_id"], 0.2, 42)


@query("f16_prepare_later_table", f"""
    WITH train AS (SELECT * FROM {GAPS} WHERE o_orderdate < TIMESTAMP '2000-01-01'),
         d AS (SELECT status, row_number() OVER (ORDER BY status) AS code FROM (SELECT DISTINCT status FROM train WHERE status IS NOT NULL))
    SELECT o_orderkey, year(o_orderdate) AS o_orderdateYear, price IS NULL AS price_is_missing,
           round(coalesce(price, (SELECT median(price) FROM train)), 4) AS price,
           g.status IS NULL AS status_is_missing, coalesce(code, 0) AS status FROM {GAPS} g LEFT JOIN d USING (status)""")
def prepare_later_table(t):
    rows = gaps(t)
    fitted = features.Preparation.fit(rows.where("o_orderdate < TIMESTAMP_NTZ '2000-01-01'"), ["price"], ["status"], "o_orderdate")
    ready = fitted.transform(rows)
    return ready.select(
        "o_orderkey", F.col("o_orderdateYear").cast("bigint").alias("o_orderdateYear"), "price_is_missing",
        F.round("price", 4).alias("price"), "status_is_missing", "status",
    )
