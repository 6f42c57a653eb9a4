"""Metrics of predictions, as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.ordering import add_running_totals


def accuracy(truth: Column, predicted: Column) -> Column:
    """Share of correct rows, as an aggregate expression."""
    return F.avg(F.when(truth == predicted, 1.0).otherwise(0.0))


def binary_metrics(df: DataFrame, truth: str, predicted: str, digits: int = 2) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class 1, rounded; 0 when undefined."""
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    counts = df.agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(truth) == F.col(predicted)).alias("right"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    shares = {
        "accuracy": F.try_divide(F.col("right"), F.col("n")),
        "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn),
        "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
    }
    return counts.select(*[F.round(F.coalesce(s, F.lit(0.0)), digits).alias(n) for n, s in shares.items()])


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Rows per (truth, predicted)."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_wide(df: DataFrame, truth: str, predicted: str, classes: list | None = None) -> DataFrame:
    """Confusion matrix with one column per predicted class; 0 where no row falls.

    Without ``classes`` the columns are the predicted classes that occur, a bounded list.
    """
    if classes is None:
        classes = sorted(r[0] for r in df.select(predicted).where(F.col(predicted).isNotNull()).distinct().collect())
    spread = df.groupBy(F.col(truth).alias("truth")).pivot(predicted, classes).agg(F.count(F.lit(1))).fillna(0)
    return spread.select("truth", *[F.col(str(c)).alias(f"predicted_{c}") for c in classes])


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means.

    Works on the confusion counts, whose size is the number of classes squared.
    """
    cells = confusion(df, truth, predicted)
    kind = F.explode(F.array(
        F.struct(F.col("truth").alias("class"), F.lit(1).alias("is_truth"), F.col("n")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).alias("is_truth"), F.col("n")),
    )).alias("side")
    hits = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")
    per_class = (
        cells.select(hits, kind)
        .groupBy(F.col("side.class").cast("string").alias("class"))
        .agg(
            F.sum(F.when(F.col("side.is_truth") == 1, F.col("hit")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("side.is_truth") == 1, F.col("side.n")).otherwise(0)).alias("support"),
            F.sum(F.when(F.col("side.is_truth") == 0, F.col("side.n")).otherwise(0)).alias("called"),
        )
        .select(
            "class",
            F.coalesce(F.try_divide("tp", "called"), F.lit(0.0)).alias("precision"),
            F.coalesce(F.try_divide("tp", "support"), F.lit(0.0)).alias("recall"),
            F.coalesce(F.try_divide(2 * F.col("tp"), F.col("called") + F.col("support")), F.lit(0.0)).alias("f1"),
            "support",
        )
    )
    scores = ["precision", "recall", "f1"]
    macro = per_class.agg(*[F.avg(s).alias(s) for s in scores], F.sum("support").alias("support"))
    weighted = per_class.agg(
        *[(F.sum(F.col(s) * F.col("support")) / F.sum("support")).alias(s) for s in scores],
        F.sum("support").alias("support"),
    )
    named = [m.select(F.lit(n).alias("class"), *scores, "support")
             for n, m in (("macro avg", macro), ("weighted avg", weighted))]
    return per_class.unionByName(named[0]).unionByName(named[1])


def _score_totals(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Positives and negatives at or above each score; equal scores are one row first."""
    positive = F.count_if(F.col(truth) == 1).alias("pos")
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(positive, F.count_if(F.col(truth) != 1).alias("neg"))
    return add_running_totals(per_score, [F.desc("threshold")], {"tp": "pos", "fp": "neg"})


def roc_points(df: DataFrame, truth: str, score: str) -> DataFrame:
    """True and false positive rate at every score, from the origin on."""
    totals = _score_totals(df, truth, score)
    all_pos = totals.agg(F.sum("pos").alias("p")).scalar()
    all_neg = totals.agg(F.sum("neg").alias("n")).scalar()
    points = totals.select(
        "threshold",
        F.try_divide(F.col("fp"), all_neg).alias("fpr"),
        F.try_divide(F.col("tp"), all_pos).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under the ROC curve; equal scores count half."""
    totals = _score_totals(df, truth, score)
    won = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return totals.agg(F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("auc"))


def regression_metrics(truth: Column, predicted: Column) -> dict[str, Column]:
    """MAE, MSE, R2 and RMSLE as aggregate expressions of one pass."""
    truth, predicted = truth.cast("double"), predicted.cast("double")
    miss = predicted - truth
    squares = F.sum(miss * miss)
    spread = F.var_pop(truth) * F.count(truth)
    logged = F.log1p(predicted) - F.log1p(truth)
    return {
        "mae": F.avg(F.abs(miss)),
        "mse": F.avg(miss * miss),
        "r2": F.lit(1.0) - F.try_divide(squares, spread),
        "rmsle": F.sqrt(F.avg(logged * logged)),
    }


def split_scores(df: DataFrame, split: str, truth: str, predicted: str) -> DataFrame:
    """MAE, RMSLE and R2 of each part of a split."""
    found = regression_metrics(F.col(truth), F.col(predicted))
    return df.groupBy(split).agg(*[found[m].alias(m) for m in ("mae", "rmsle", "r2")])


def cross_entropy(label: Column, probabilities: Column) -> Column:
    """Mean of ``-log`` of the probability given to the label (classes from 0)."""
    return F.avg(-F.log(F.get(probabilities, label.cast("int"))))


def batch_means(df: DataFrame, batch: str, value: str) -> DataFrame:
    """Mean of the batches' means, and the mean over rows beside it."""
    per_batch = df.groupBy(batch).agg(F.avg(value).alias("m"), F.sum(value).alias("s"), F.count(value).alias("n"))
    return per_batch.agg(F.avg("m").alias("batch_mean"), (F.sum("s") / F.sum("n")).alias("row_mean"))


def best_runs(log: DataFrame, keys: list[str], metric: str, run: str) -> DataFrame:
    """Per key, the run with the highest metric; the lowest run among equals."""
    best = F.min_by(F.struct(run, metric), F.struct(-F.col(metric), F.col(run))).alias("__b")
    return log.groupBy(*keys).agg(best).select(*keys, "__b.*")
