"""L and T5: models on the given tables, and the nearest-neighbour vote."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.catalog.texts import PAIRS, WORDS
from lakeops.durable import fresh_path, materialize
from lakeops.functions.scalars import date_parts
from lakeops.ml import features, gram, models, neighbours, network
from lakeops.operators import joins, ranking, text

PRICE_COLUMNS = ["l_quantity", "l_discount", "l_tax", "saleYear", "saleMonth"]
DOCUMENT_COLUMNS = ["n_chars", "n_words", "n_lines", "word_length", "marks", "capitals", "distinct"]
LENGTH_COLUMNS = ["n_words", "n_lines", "word_length"]


def vectors(t):
    """Vectors and their class."""
    return t.embeddings.select("vec_id", models.vector_of("embedding").alias("features"), F.col("label").cast("double").alias("label"))


def lines(t, *keep):
    """Line items with the price as label."""
    rows = t.lineitem.withColumns(date_parts(F.col("l_shipdate"), "sale"))
    return models.assembled(rows, PRICE_COLUMNS, "l_extendedprice", list(keep))


def documents(t):
    """Labelled documents with simple counts; the label is their quality."""
    return models.assembled(counted_documents(t), DOCUMENT_COLUMNS, "quality", ["doc_id"])


def lengths(t):
    """Documents with their length as label."""
    counted = with_counts(t.documents.where("text IS NOT NULL")).select("n_chars", *LENGTH_COLUMNS)
    return models.assembled(materialize(counted, "lengths"), LENGTH_COLUMNS, "n_chars")


# a fit goes over its rows many times; texts are read and counted once, and the counts written
def counted_documents(t):
    # texts without a label are not counted, and none is shuffled
    counted = with_counts(joins.likely_matches(t.documents, t.labels, "doc_id")).join(t.labels, "doc_id")
    return materialize(counted.select("doc_id", "lang", *DOCUMENT_COLUMNS, "quality"), "counted")


def with_counts(documents):
    words = F.split(F.lower(F.trim("text")), r"\s+")
    share = lambda left_out: F.length(F.regexp_replace("text", left_out, "")) / F.greatest(F.length("text"), F.lit(1))
    return documents.withColumns({
        "n_words": F.size(words), "n_lines": F.size(F.split("text", "\n")), "word_length": F.length("text") / F.size(words),
        "marks": share(r"[\p{L}\s]+"), "capitals": share("[^A-Z]+"), "distinct": F.size(F.array_distinct(words)) / F.size(words),
    }).drop("text")


def halves(df, *ids):
    """Training and test rows by their seeded key."""
    part = features.hashed_split(list(ids), {"train": 0.8, "test": 0.2}, 42)
    tagged = df.withColumn("part", part)
    return tagged.where("part = 'train'").drop("part"), tagged.where("part = 'test'").drop("part")


def scored(model, df, *keep):
    return model.transform(df).select(*keep, "label", "prediction")


def per_label(df, *measures):
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *measures)


def majority(df):
    """The share of the most frequent label: what calling it always gets right."""
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("c"))
    return counts.agg((F.max("c") / F.sum("c")).alias("m"))


def against_majority(found, times=1.0, left=1.0):
    """Rows, the majority's share, and whether the calls are right more than ``times`` as often and wrong at most ``left`` as often."""
    right = found.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("right"))
    beats = (F.col("right") > times * F.col("m")) & (1 - F.col("right") <= left * (1 - F.col("m")))
    return right.withColumn("m", majority(found).scalar()).select("n", F.round("m", 6).alias("majority_share"), beats.alias("beats_majority"))


def majority_sql(label, rows):
    counts = f"(SELECT count(*) AS c FROM {rows} GROUP BY {label})"
    return f"SELECT sum(c)::BIGINT AS n, round(max(c) / sum(c), 6)::DOUBLE AS majority_share, TRUE AS beats_majority FROM {counts}"


def against_mean(found, left=0.5):
    """Rows, the error of always saying the mean, and whether that of the predictions is at most ``left`` of it."""
    error = F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))
    sums = found.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("e"), error.alias("own"))
    return sums.select("n", F.round("e", 4).alias("mean_error"), (F.col("own") <= left * F.col("e")).alias("below_it"))


def total_probability(name="probability"):
    return F.aggregate(vector_to_array(name), F.lit(0.0), lambda s, x: s + x)


# with a free intercept the probabilities of a class add up to its rows
@query("l1_logistic_regression", f"""
    SELECT label::DOUBLE AS label, count(*) AS n, count(*) AS expected, any_value(beats_majority) AS beats_majority
    FROM embeddings, ({majority_sql('label', 'embeddings')}) GROUP BY 1""")
def logistic_regression(t):
    fitted = LogisticRegression(regParam=0.01, maxIter=100, tol=1e-9).fit(vectors(t))
    found = fitted.transform(vectors(t))
    probabilities = found.select(F.posexplode(vector_to_array("probability")).alias("label", "p"))
    expected = probabilities.groupBy(F.col("label").cast("double").alias("label")).agg(F.round(F.sum("p")).cast("bigint").alias("expected"))
    return per_label(vectors(t)).join(expected, "label").withColumn("beats_majority", against_majority(found, 2.0).select("beats_majority").scalar())


def forest_calls(t):
    return RandomForestClassifier(numTrees=20, maxDepth=6, seed=42).fit(vectors(t)).transform(vectors(t))


@query("l2_forest_classifier", majority_sql("label", "embeddings"))
def forest_classifier(t):
    return against_majority(forest_calls(t), 2.0)


@query("l2_forest_predictions")
def forest_predictions(t):
    return models.with_probability(forest_calls(t), ["vec_id", "label"])


def forest_prices(t):
    rows = lines(t, "l_orderkey", "l_linenumber")
    return scored(models.forest_regressor(numTrees=10, maxDepth=6, seed=42).fit(rows), rows, "l_orderkey", "l_linenumber")


# the prices of order lines hang on nothing they hold, so what a fit is worth shows on the lengths of documents
ERROR_SQL = "SELECT count(*) AS n, round(stddev_pop(n_chars), 4) AS mean_error, TRUE AS below_it FROM documents WHERE text IS NOT NULL"


@query("l3_forest_regressor", ERROR_SQL)
def forest_regressor(t):
    rows = lengths(t)
    return against_mean(scored(models.forest_regressor(numTrees=10, maxDepth=8, seed=42).fit(rows), rows))


@query("l3_forest_predictions")
def price_predictions(t):
    return forest_prices(t)


# one column: the slope shrinks by 1 + penalty / deviation of the label
@query("l4_ridge", """
    SELECT round(regr_slope(l_extendedprice, l_quantity) / (1 + 1000.0::DOUBLE / stddev_samp(l_extendedprice)), 2) AS slope FROM lineitem""")
def ridge(t):
    rows = models.assembled(t.lineitem, ["l_quantity"], "l_extendedprice")
    fitted = LinearRegression(elasticNetParam=0.0, regParam=1000.0, solver="normal").fit(rows)
    return t.spark.createDataFrame([(round(float(fitted.coefficients[0]), 2),)], "slope double")


LABELLED_DOCUMENTS = "(documents JOIN labels USING (doc_id))"


# at most half of the majority's errors are left
@query("l5_linear_svm", majority_sql("quality", LABELLED_DOCUMENTS))
def linear_svm(t):
    rows = documents(t)
    return against_majority(scored(LinearSVC(maxIter=30).fit(rows), rows, "doc_id"), left=0.5)


# every vector is classed by the five nearest of the others
@query("l6_neighbour_vote", """
    WITH d AS (SELECT a.vec_id, b.vec_id AS other, b.label::VARCHAR AS label,
                      list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ** 2)) AS dist
               FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
         k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, other) AS r FROM d),
         v AS (SELECT vec_id, label, count(*) AS n FROM k WHERE r <= 5 GROUP BY 1, 2)
    SELECT vec_id AS query, label AS predicted, n AS votes FROM (
      SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) AS r FROM v) WHERE r = 1""")
def neighbour_vote(t):
    near = neighbours.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", "label", 5, skip_self=True)
    return neighbours.vote(near)


@query("l7_line_fit", """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""")
def line_fit(t):
    return t.lineitem.agg(
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"),
    )


# trees of leaf means leave residuals that add up to nothing
@query("l8_boosted_regression", f"SELECT *, (SELECT round(avg(n_chars)) FROM documents WHERE text IS NOT NULL) AS mean FROM ({ERROR_SQL})")
def boosted_regression(t):
    rows = lengths(t)
    found = scored(GBTRegressor(maxIter=10, maxDepth=4, seed=42).fit(rows), rows)
    return against_mean(found).withColumn("mean", found.agg(F.round(F.avg("prediction"))).scalar())


def perceptron_calls(t):
    net = MultilayerPerceptronClassifier(layers=[64, 16, 10], maxIter=30, seed=42)
    return net.fit(vectors(t)).transform(vectors(t))


@query("l9_perceptron", majority_sql("label", "embeddings"))
def perceptron(t):
    return against_majority(perceptron_calls(t), 2.0)


@query("l9_perceptron_predictions")
def perceptron_predictions(t):
    return models.with_probability(perceptron_calls(t), ["vec_id", "label"])


# the next character is better known from the one before than from how often each occurs
@query("l10_pair_regression", f"""
    WITH {WORDS}, {PAIRS}, c AS (SELECT c2, sum(n)::DOUBLE AS n FROM pairs GROUP BY 1), t AS (SELECT sum(n) AS t FROM c)
    SELECT round(any_value(t))::BIGINT AS n, round(-sum(n / t * ln(n / t)), 6) AS entropy, TRUE AS below_it FROM c, t""")
def pair_regression(t):
    pairs = materialize(text.pair_counts(text.word_counts(t.documents, "text")), "pairs")
    found = models.pair_regression(pairs).transform(pairs)
    told = F.element_at(vector_to_array("probability"), F.col("label").cast("int") + 1)
    own = found.agg((-F.sum(F.col("n") * F.log(told)) / F.sum("n")).alias("own"))
    shares = pairs.groupBy("c2").agg(F.sum("n").alias("n")).withColumn("t", pairs.agg(F.sum("n")).scalar()).withColumn("p", F.col("n") / F.col("t"))
    entropy = shares.agg(F.sum("n").alias("n"), (-F.sum(F.col("p") * F.log("p"))).alias("e"))
    return entropy.withColumn("own", own.scalar()).select("n", F.round("e", 6).alias("entropy"), (F.col("own") < F.col("e")).alias("below_it"))


def quality_scores():
    return MulticlassClassificationEvaluator(metricName="accuracy")


# the folds and parts of the labelled documents
LABELLED = "(SELECT doc_id, quality, md5('42:' || doc_id) AS h FROM documents JOIN labels USING (doc_id))"
FOLDS = f"(SELECT ('0x' || h[1:8])::BIGINT % 3 AS fold, count(*) AS n FROM {LABELLED} GROUP BY 1)"


def by_fold(table, df, ids, folds):
    """Beside the rows of each fold whether a draw's score is above the share of the most frequent label."""
    counts = models.with_fold(df, ids, folds, 42).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    scores = table.withColumn("m", majority(df).scalar())
    draws = scores.select("draw", F.round("m", 6).alias("majority_share"), (F.col("score") > F.col("m")).alias("beats_majority"),
                          F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"))
    return draws.join(counts, "fold").select(
        F.col("draw").cast("bigint").alias("draw"), F.col("fold").cast("bigint").alias("fold"), "n", "majority_share", "beats_majority")


def cross_sql(draws):
    whole = majority_sql("quality", LABELLED)
    return f"SELECT draw, fold, f.n, majority_share, beats_majority FROM {FOLDS} f, (SELECT unnest(range({draws})) AS draw), ({whole})"


# sums of a fold, and the weights and scores of a line fitted on others
SUMS = "count(*)::DOUBLE AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy"
ADDED = ", ".join(f"sum(b.{c}) AS {c}" for c in ("n", "sx", "sy", "sxx", "sxy", "syy"))
SLOPE = "(sxy - sx * sy / n) / (sxx - sx * sx / n + penalty)"
R2 = "round(1 - (syy - 2 * a * sxy - 2 * b * sy + a * a * sxx + 2 * a * b * sx + b * b * n) / (syy - sy * sy / n), 6)"
# a text's bytes by its characters
BYTES = "SELECT md5('42:' || doc_id) AS h, n_chars::DOUBLE AS x, strlen(text)::DOUBLE AS y FROM documents WHERE text IS NOT NULL"
PENALTIES = [0.0, 1e8, 1e10]


def text_bytes(t):
    return t.documents.select("doc_id", "n_chars", F.octet_length("text").alias("bytes"))


@query("l11_cross_validation", f"""
    WITH f AS (SELECT ('0x' || h[1:8])::BIGINT % 5 AS fold, {SUMS} FROM ({BYTES}) GROUP BY 1),
         t AS (SELECT a.fold AS of, {ADDED} FROM f a JOIN f b ON a.fold <> b.fold GROUP BY 1),
         s AS (SELECT of, penalty, {SLOPE} AS a, n AS tn, sx AS tx, sy AS ty FROM t, (SELECT unnest({PENALTIES}) AS penalty)),
         w AS (SELECT of, penalty, a, (ty - a * tx) / tn AS b FROM s)
    SELECT penalty::DOUBLE AS penalty, fold, n::BIGINT AS n, {R2} AS r2 FROM f JOIN w ON fold = of""")
def cross_validation(t):
    table = gram.cross_scores(text_bytes(t), ["n_chars"], "bytes", ["doc_id"], PENALTIES)
    return table.withColumn("r2", F.round("r2", 6))


@query("l12_random_search", cross_sql(4))
def random_search(t):
    forest = RandomForestClassifier(seed=42)
    grid = models.grid_of({forest.numTrees: [5, 10], forest.maxDepth: [3, 5], forest.minInstancesPerNode: [1, 5]})
    rows = documents(t)
    _, table = models.cross_scores(forest, models.drawn_from(grid, 4), rows, quality_scores(), ["doc_id"], folds=3)
    return by_fold(table, rows, ["doc_id"], 3)


@query("l13_grid_search", cross_sql(4))
def grid_search(t):
    hot = features.one_hot_stages(["lang"], DOCUMENT_COLUMNS)
    model = LogisticRegression(maxIter=10)
    rows = counted_documents(t).select("doc_id", "lang", *DOCUMENT_COLUMNS, F.col("quality").cast("double").alias("label"))
    grid = models.grid_of({hot[1].dropLast: [True, False], model.regParam: [0.0, 0.01]})
    _, table = models.cross_scores(Pipeline(stages=[*hot, model]), grid, rows, quality_scores(), ["doc_id"], folds=3)
    return by_fold(table, rows, ["doc_id"], 3)


@query("l14_parameter_sweep", f"""
    WITH f AS (SELECT CASE WHEN h < 'cccccccc' THEN 'train' ELSE 'test' END AS part, {SUMS} FROM ({BYTES}) GROUP BY 1),
         s AS (SELECT penalty, {SLOPE} AS a, n AS tn, sx AS tx, sy AS ty FROM f, (SELECT unnest({PENALTIES}) AS penalty) WHERE part = 'train'),
         w AS (SELECT penalty, a, (ty - a * tx) / tn AS b FROM s)
    SELECT penalty::DOUBLE AS penalty, part, n::BIGINT AS n, {R2} AS r2 FROM f, w""")
def parameter_sweep(t):
    part = features.hashed_split(["doc_id"], {"train": 0.8, "test": 0.2}, 42)
    table = gram.sweep(text_bytes(t).withColumn("part", part), "part", ["n_chars"], "bytes", PENALTIES)
    return table.withColumn("r2", F.round("r2", 6))


TEST_ROWS = f"(SELECT * FROM {LABELLED} WHERE h >= 'cccccccc')"


@query("l15_fit_and_score", f"""
    SELECT model, count(*) FILTER (h < 'cccccccc') AS train_rows, count(*) FILTER (h >= 'cccccccc') AS test_rows,
           any_value(majority_share) AS majority_share, any_value(beats_majority) AS beats_majority
    FROM {LABELLED}, (VALUES ('logistic'), ('forest'), ('svm')) v(model), ({majority_sql('quality', TEST_ROWS)}) GROUP BY 1""")
def fit_and_score(t):
    train, test = halves(documents(t), "doc_id")
    table = models.fit_and_score(
        {"logistic": LogisticRegression(maxIter=20), "forest": RandomForestClassifier(numTrees=10, seed=42), "svm": LinearSVC(maxIter=20)},
        train, test, quality_scores(),
    )
    sizes = {"train_rows": train.agg(F.count(F.lit(1))).scalar(), "test_rows": test.agg(F.count(F.lit(1))).scalar(), "m": majority(test).scalar()}
    return table.withColumns(sizes).select(
        "model", "train_rows", "test_rows", F.round("m", 6).alias("majority_share"), (F.col("score") > F.col("m")).alias("beats_majority"))


def logistic_calls(t):
    return LogisticRegression(regParam=0.01, maxIter=30).fit(vectors(t)).transform(vectors(t))


# the predicted class has the largest of ten probabilities, and is the right one far more often than the majority's
@query("l16_probabilities", f"SELECT *, n AS in_range FROM ({majority_sql('label', 'embeddings')})")
def probabilities(t):
    found = models.with_probability(logistic_calls(t), ["vec_id", "label"]).withColumn("prediction", F.col("pred_class").cast("double"))
    classes = t.embeddings.agg(F.countDistinct("label")).scalar()
    in_range = F.col("pred_prob").between(1 / F.col("classes") - 1e-9, F.lit(1.0))
    counted = found.withColumn("classes", classes).agg(F.count_if(in_range)).scalar()
    return against_majority(found, 2.0).withColumn("in_range", counted)


@query("l16_prediction_table")
def prediction_table(t):
    return models.with_probability(logistic_calls(t), ["vec_id", "label"])


# the saved network, run batch by batch, says what the fitted model says of every vector
@query("l16_batch_predictions", f"SELECT *, n AS same FROM ({majority_sql('label', 'embeddings')})")
def batch_predictions(t):
    net = MultilayerPerceptronClassifier(layers=[64, 16, 10], maxIter=30, seed=42).fit(vectors(t))
    path = fresh_path(t.spark, "network")
    network.save_layers(t.spark, network.layers_of(net), path)
    found = network.predict(t.embeddings.withColumn("label", F.col("label").cast("double")), path, 64, "embedding")
    own = net.transform(found.withColumnRenamed("probability", "told").withColumn("features", models.vector_of("embedding")))
    apart = F.array_max(F.zip_with("told", vector_to_array("probability"), lambda a, b: F.abs(a - b)))
    told = materialize(own.select("label", "prediction", ((F.col("prediction") == F.col("pred_class")) & (apart < 1e-9)).alias("same")), "told")
    return against_majority(told, 2.0).withColumn("same", told.agg(F.count_if("same")).scalar())


@query("l17_id_and_prediction", """
    WITH p AS (SELECT *, md5('42:' || l_orderkey || ':' || l_linenumber) < 'cccccccc' AS train FROM lineitem),
         f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM p WHERE train)
    SELECT l_orderkey, l_linenumber, round(a * l_quantity + b, 2) AS price FROM lineitem, f""")
def id_and_prediction(t):
    rows = models.assembled(t.lineitem, ["l_quantity"], "l_extendedprice", ["l_orderkey", "l_linenumber"])
    train, _ = halves(rows, "l_orderkey", "l_linenumber")
    fitted = LinearRegression(solver="normal").fit(train)
    return fitted.transform(rows).select("l_orderkey", "l_linenumber", F.round("prediction", 2).alias("price"))


# two columns: the weights solve two equations of their covariances
WEIGHTS = """
    WITH c AS (SELECT covar_samp(l_quantity, l_quantity) AS qq, covar_samp(l_discount, l_discount) AS dd, covar_samp(l_quantity, l_discount) AS qd,
                      covar_samp(l_quantity, l_extendedprice) AS qy, covar_samp(l_discount, l_extendedprice) AS dy FROM lineitem),
         w AS (SELECT 'l_quantity' AS feature, (dd * qy - qd * dy) / (qq * dd - qd * qd) AS weight, sqrt(qq) AS spread FROM c
               UNION ALL SELECT 'l_discount', (qq * dy - qd * qy) / (qq * dd - qd * qd), sqrt(dd) FROM c)"""
WEIGHED = ["l_quantity", "l_discount"]


def price_weights(t):
    fitted = LinearRegression(solver="normal").fit(models.assembled(t.lineitem, WEIGHED, "l_extendedprice"))
    return models.weights_table(t.spark, fitted, WEIGHED)


@query("l18_named_weights", f"{WEIGHTS} SELECT feature, round(weight, 2) AS weight FROM w")
def named_weights(t):
    return price_weights(t).withColumn("weight", F.round("weight", 2))


@query("l18_forest_importances")
def forest_importances(t):
    forest = RandomForestRegressor(numTrees=10, maxDepth=5, seed=42).fit(lines(t))
    return models.weights_table(t.spark, forest, PRICE_COLUMNS)


@query("l19_saved_model", "SELECT count(*) AS n, 0.0::DOUBLE AS largest_difference FROM lineitem")
def saved_model(t):
    rows = lines(t)
    fitted = Pipeline(stages=[LinearRegression(regParam=0.1)]).fit(rows)
    path = fresh_path(t.spark, "model")
    models.save_model(fitted, path)
    again = models.load_chain(path)
    both = again.transform(fitted.transform(rows).select("features", F.col("prediction").alias("before")))
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("prediction") - F.col("before"))).alias("largest_difference"))


# a weight counts by how far its column spreads
@query("t5_top_features", f"{WEIGHTS} SELECT arg_max(feature, abs(weight) * spread) AS feature, round(max(abs(weight) * spread), 2) AS importance FROM w")
def top_features(t):
    spread = t.lineitem.agg(*[F.stddev_samp(c).alias(c) for c in WEIGHED]).unpivot([], WEIGHED, "feature", "spread")
    weighed = price_weights(t).join(spread, "feature").select("feature", F.round(F.abs("weight") * F.col("spread"), 2).alias("importance"))
    return ranking.first_rows(weighed, [F.desc("importance"), "feature"], 1)


@query("t5_forest_features")
def forest_features(t):
    forest = RandomForestRegressor(numTrees=10, maxDepth=5, seed=42).fit(lines(t))
    return ranking.first_rows(models.weights_table(t.spark, forest, PRICE_COLUMNS), [F.desc("weight"), "feature"], 3)
