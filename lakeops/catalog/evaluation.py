"""E: metrics of predictions."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.durable import fresh_path
from lakeops.functions import arrays
from lakeops.ml import metrics
from lakeops.sinks.tables import append_partitioned

# truth, score and call of every labelled document
BINARY = """(SELECT doc_id, quality, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS called FROM (
    SELECT doc_id, quality, ((doc_id * 37) % 101) / 101.0::DOUBLE AS score FROM labels))"""
# truth and estimate of every order's price
PRICES = """(SELECT o_orderkey, year(o_orderdate) AS y, o_totalprice AS truth, o_totalprice * (0.9 + (o_orderkey % 21) / 100.0::DOUBLE) AS guess FROM orders)"""
# minus the squared distance of every vector to the centre of every class
CENTRES = """c AS (SELECT label AS k, pos, avg(x) AS m FROM (
      SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2),
    cc AS (SELECT k, list(m ORDER BY pos) AS centre FROM c GROUP BY k),
    near AS (SELECT vec_id, label, k, -list_sum(list_transform(list_zip(embedding, centre), lambda p: (p[1]::DOUBLE - p[2]) ** 2)) AS score FROM embeddings, cc)"""
# class of every vector and the class whose centre is nearest
CLASSES = f"""(WITH {CENTRES} SELECT vec_id, label::BIGINT AS truth, arg_max(k, score)::BIGINT AS called FROM near GROUP BY vec_id, label)"""


def binary(t):
    score = (F.col("doc_id") * 37 % 101) / F.lit(101.0)
    rows = t.labels.select("doc_id", "quality", score.alias("score"))
    return rows.withColumn("called", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def prices(t):
    factor = F.lit(0.9) + (F.col("o_orderkey") % 21) / F.lit(100.0)
    return t.orders.select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("y"), F.col("o_totalprice").alias("truth"),
                           (F.col("o_totalprice") * factor).alias("guess"))


def scored_vectors(t):
    """Every vector with its class, and per class, in order, minus the squared distance to its centre."""
    cells = t.embeddings.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centre = F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centre")
    # one row for each class
    centres = means.groupBy("label").agg(centre).agg(F.array_sort(F.collect_list(F.struct("label", "centre"))).alias("c")).scalar()

    def score(c):
        apart = F.zip_with("embedding", c["centre"], lambda x, m: F.pow(x.cast("double") - m, F.lit(2.0)))
        return -F.aggregate(apart, F.lit(0.0), lambda s, x: s + x)
    return t.embeddings.withColumn("centres", centres).select(
        "vec_id", "label", F.transform("centres", lambda c: c["label"]).alias("labels"), F.transform("centres", score).alias("scores"),
    )


def classes(t):
    rows = scored_vectors(t)
    return rows.select(
        "vec_id", F.col("label").cast("bigint").alias("truth"), F.get("labels", arrays.argmax(F.col("scores")).cast("int")).cast("bigint").alias("called"),
    )


@query("e1_accuracy", f"SELECT round(100 * avg(CASE WHEN quality = called THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM {BINARY}")
def accuracy(t):
    return binary(t).agg(F.round(100 * metrics.accuracy(F.col("quality"), F.col("called")), 6).alias("accuracy"))


@query("e2_binary_metrics", f"""
    WITH c AS (SELECT count(*) FILTER (quality = 1 AND called = 1) AS tp, count(*) FILTER (quality <> 1 AND called = 1) AS fp,
                      count(*) FILTER (quality = 1 AND called <> 1) AS fn, count(*) AS n, count(*) FILTER (quality = called) AS ok FROM {BINARY})
    SELECT round(ok / n, 2) AS accuracy, round(tp / (tp + fp), 2) AS precision, round(tp / (tp + fn), 2) AS recall,
           round(2 * tp / (2 * tp + fp + fn), 2) AS f1 FROM c""")
def binary_metrics(t):
    return metrics.binary_metrics(binary(t), "quality", "called")


@query("e3_class_report", f"""
    WITH r AS (SELECT truth AS c, count(*) AS support, count(*) FILTER (truth = called) AS tp FROM {CLASSES} GROUP BY 1),
         p AS (SELECT called AS c, count(*) AS called FROM {CLASSES} GROUP BY 1),
         k AS (SELECT c::VARCHAR AS class, CASE WHEN coalesce(called, 0) = 0 THEN 0.0 ELSE coalesce(tp, 0) / called END AS precision,
                      CASE WHEN coalesce(support, 0) = 0 THEN 0.0 ELSE coalesce(tp, 0) / support END AS recall,
                      2 * coalesce(tp, 0) / (coalesce(called, 0) + coalesce(support, 0)) AS f1, coalesce(support, 0) AS support FROM r FULL JOIN p USING (c))
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM k
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM k
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                     round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM k""")
def class_report(t):
    rows = metrics.class_report(classes(t), "truth", "called")
    return rows.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("e4_confusion", f"SELECT truth, called AS predicted, count(*) AS n FROM {CLASSES} GROUP BY 1, 2")
def confusion(t):
    return metrics.confusion(classes(t), "truth", "called")


@query("e4_confusion_wide", f"""
    SELECT quality AS truth, count(*) FILTER (called = 0) AS predicted_0, count(*) FILTER (called = 1) AS predicted_1 FROM {BINARY} GROUP BY 1""")
def confusion_wide(t):
    return metrics.confusion_wide(binary(t), "quality", "called")


@query("e5_roc_points", f"""
    WITH s AS (SELECT score, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality <> 1) AS neg FROM {BINARY} GROUP BY 1)
    SELECT score AS threshold, round(sum(neg) OVER (ORDER BY score DESC)::DOUBLE / sum(neg) OVER (), 9) AS fpr,
           round(sum(pos) OVER (ORDER BY score DESC)::DOUBLE / sum(pos) OVER (), 9) AS tpr FROM s
    UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0""")
def roc_points(t):
    points = metrics.roc_points(binary(t), "quality", "score")
    return points.withColumns({c: F.round(c, 9) for c in ("fpr", "tpr")})


@query("e6_roc_auc", f"""
    WITH r AS (SELECT quality, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM {BINARY})
    SELECT round((sum(rk) FILTER (quality = 1) - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2.0::DOUBLE)
           / (count(*) FILTER (quality = 1) * count(*) FILTER (quality <> 1)), 9) AS auc FROM r""")
def roc_auc(t):
    return metrics.roc_auc(binary(t), "quality", "score").select(F.round("auc", 9).alias("auc"))


@query("e7_regression_metrics", f"""
    SELECT round(avg(abs(guess - truth)), 4) AS mae, round(avg((guess - truth) ** 2), 2) AS mse,
           round(1 - sum((guess - truth) ** 2) / (var_pop(truth) * count(*)), 6) AS r2 FROM {PRICES}""")
def regression_metrics(t):
    found = metrics.regression_metrics(F.col("truth"), F.col("guess"))
    return prices(t).agg(F.round(found["mae"], 4).alias("mae"), F.round(found["mse"], 2).alias("mse"), F.round(found["r2"], 6).alias("r2"))


@query("e7_mean_baseline", f"SELECT abs(round(1 - sum((m - truth) ** 2) / (var_pop(truth) * count(*)), 6)) AS r2 FROM (SELECT truth, avg(truth) OVER () AS m FROM {PRICES})")
def mean_baseline(t):
    rows = prices(t)
    mean = rows.agg(F.avg("truth")).scalar()
    found = metrics.regression_metrics(F.col("truth"), F.col("mean"))
    return rows.withColumn("mean", mean).agg(F.abs(F.round(found["r2"], 6)).alias("r2"))


@query("e7_residuals", f"SELECT o_orderkey, round(guess - truth, 4) AS residual, round((guess - truth) ** 2, 2) AS squared FROM {PRICES}")
def residuals(t):
    miss = F.col("guess") - F.col("truth")
    return prices(t).select("o_orderkey", F.round(miss, 4).alias("residual"), F.round(miss * miss, 2).alias("squared"))


@query("e8_rmsle", f"SELECT round(sqrt(avg((ln(1 + guess) - ln(1 + truth)) ** 2)), 6) AS rmsle FROM {PRICES}")
def rmsle(t):
    found = metrics.regression_metrics(F.col("truth"), F.col("guess"))["rmsle"]
    return prices(t).agg(F.round(found, 6).alias("rmsle"))


@query("e9_split_scores", f"""
    SELECT CASE WHEN y = 2000 THEN 'valid' ELSE 'train' END AS part, round(avg(abs(guess - truth)), 4) AS mae,
           round(sqrt(avg((ln(1 + guess) - ln(1 + truth)) ** 2)), 6) AS rmsle,
           round(1 - sum((guess - truth) ** 2) / (var_pop(truth) * count(*)), 6) AS r2 FROM {PRICES} GROUP BY 1""")
def split_scores(t):
    rows = prices(t).withColumn("part", F.when(F.col("y") == 2000, "valid").otherwise("train"))
    scores = metrics.split_scores(rows, "part", "truth", "guess")
    return scores.select("part", F.round("mae", 4).alias("mae"), F.round("rmsle", 6).alias("rmsle"), F.round("r2", 6).alias("r2"))


@query("e11_cross_entropy", f"""
    WITH {CENTRES}, e AS (SELECT vec_id, label, k, exp(score - max(score) OVER (PARTITION BY vec_id)) AS e FROM near),
    p AS (SELECT *, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM e)
    SELECT round(avg(-ln(p)), 6) AS cross_entropy FROM p WHERE k = label""")
def cross_entropy(t):
    rows = scored_vectors(t).select((F.array_position("labels", F.col("label")) - 1).alias("at"), arrays.softmax(F.col("scores")).alias("p"))
    return rows.agg(F.round(metrics.cross_entropy(F.col("at"), F.col("p")), 6).alias("cross_entropy"))


@query("e12_batch_means", """
    SELECT round(avg(m), 6) AS batch_mean, round(sum(s) / sum(n), 6) AS row_mean FROM (
      SELECT user_id, avg(value) AS m, sum(value) AS s, count(*) AS n FROM events GROUP BY 1)""")
def batch_means(t):
    found = metrics.batch_means(t.events, "user_id", "value")
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query("e13_prediction_table", f"""
    WITH {CENTRES}, e AS (SELECT *, exp(score - max(score) OVER (PARTITION BY vec_id)) AS e FROM near)
    SELECT 'vectors/' || label || '/' || vec_id AS path, label::VARCHAR AS class_name, round(max(e) / sum(e), 6) AS pred_prob,
           arg_max(k, score)::VARCHAR AS pred_class, arg_max(k, score) = label AS correct FROM e GROUP BY vec_id, label""")
def prediction_table(t):
    # truth is read back from the path's parent folder
    rows = scored_vectors(t).select(
        F.concat_ws("/", F.lit("vectors"), F.col("label"), F.col("vec_id")).alias("path"), "labels", "scores",
    )
    named = rows.withColumns({
        "class_name": F.element_at(F.split("path", "/"), -2), "pred_prob": F.round(F.array_max(arrays.softmax(F.col("scores"))), 6),
        "pred_class": F.get("labels", arrays.argmax(F.col("scores")).cast("int")).cast("string"),
    }).drop("labels", "scores")
    return named.withColumn("correct", F.col("class_name") == F.col("pred_class"))


@query("e14_wrong_predictions", f"SELECT vec_id, truth, called FROM {CLASSES} WHERE truth <> called")
def wrong_predictions(t):
    return classes(t).where(F.col("truth") != F.col("called"))


@query("e15_mean_time", """
    SELECT l_returnflag AS model, round(avg(l_tax) FILTER (l_linestatus = 'F'), 6) AS F, round(avg(l_tax) FILTER (l_linestatus = 'O'), 6) AS O
    FROM lineitem GROUP BY 1""")
def mean_time(t):
    # flag stands for the model, status for the device and tax for the time
    spread = t.lineitem.groupBy(F.col("l_returnflag").alias("model")).pivot("l_linestatus").agg(F.avg("l_tax"))
    return spread.select("model", *[F.round(c, 6).alias(c) for c in spread.columns[1:]])


@query("e16_model_comparison", f"""
    SELECT 'all' AS model, round(avg(abs(guess - truth)), 4) AS mae, round(avg((guess - truth) ** 2), 2) AS mse FROM {PRICES}
    UNION ALL SELECT 'mean', round(avg(abs(m - truth)), 4), round(avg((m - truth) ** 2), 2) FROM (SELECT truth, avg(truth) OVER () AS m FROM {PRICES})""")
def model_comparison(t):
    rows = prices(t)
    mean = rows.agg(F.avg("truth")).scalar()
    both = rows.withColumn("mean", mean)

    def row(name, guess):
        found = metrics.regression_metrics(F.col("truth"), F.col(guess))
        return both.agg(F.round(found["mae"], 4).alias("mae"), F.round(found["mse"], 2).alias("mse")).select(F.lit(name).alias("model"), "mae", "mse")
    return row("all", "guess").unionByName(row("mean", "mean"))


@query("e17_experiment_log", """
    WITH l AS (SELECT event_type AS data, user_id AS run, round(avg(value), 4) AS metric FROM events GROUP BY 1, 2)
    SELECT data, run, metric FROM (SELECT *, row_number() OVER (PARTITION BY data ORDER BY metric DESC, run) AS rn FROM l) WHERE rn = 1""")
def experiment_log(t):
    log = t.events.groupBy(F.col("event_type").alias("data"), F.col("user_id").alias("run")).agg(F.round(F.avg("value"), 4).alias("metric"))
    # the log is a table with a folder per day of logging, read back to find the best runs
    path = fresh_path(t.spark, "experiments")
    append_partitioned(log.withColumn("logged_on", F.lit("2024-02-01").cast("date")), path, ["logged_on"])
    return metrics.best_runs(t.spark.read.schema(log.schema).parquet(path), ["data"], "metric", "run")


@query("e18_epoch_curves", """
    SELECT day(ts) AS epoch, round(avg(value) FILTER (event_type = 'view'), 4) AS train_loss,
           round(avg(value) FILTER (event_type = 'click'), 4) AS test_loss FROM events GROUP BY 1""")
def epoch_curves(t):
    long = t.events.select(
        F.dayofmonth("ts").cast("bigint").alias("epoch"), "value",
        F.when(F.col("event_type") == "view", "train_loss").when(F.col("event_type") == "click", "test_loss").alias("metric"),
    )
    wide = long.groupBy("epoch").pivot("metric", ["train_loss", "test_loss"]).agg(F.avg("value"))
    return wide.select("epoch", F.round("train_loss", 4).alias("train_loss"), F.round("test_loss", 4).alias("test_loss"))
