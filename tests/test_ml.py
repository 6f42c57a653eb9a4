import re
import shutil
import threading
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from conftest import rows
from lakeops.catalog import models as catalog
from lakeops.functions import arrays, scalars
from lakeops.ml import features, gram, metrics, models, neighbours
from lakeops.operators import joins, text
from lakeops.tables import Tables


def predictions(spark):
    # 1 in 10,000 positive, none found: accuracy misleads
    return spark.range(10_000).select((F.col("id") == 0).cast("int").alias("y"), F.lit(0).alias("p"))


def test_accuracy_misleads_on_imbalance(spark):
    row = metrics.binary_metrics(predictions(spark), "y", "p", digits=4).first()
    assert row.asDict() == {"accuracy": 0.9999, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    report = {r["class"]: r for r in metrics.class_report(predictions(spark), "y", "p").collect()}
    assert report["1"]["precision"] == 0 and report["1"]["support"] == 1 and report["0"]["recall"] == 1
    assert report["macro avg"]["recall"] == 0.5 and report["weighted avg"]["support"] == 10_000


def test_r2_of_mean_and_truth(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("y"), F.lit(49.5).alias("m"))
    r2 = [df.agg(metrics.regression_metrics(F.col("y"), F.col(c))["r2"].alias("r")).first()["r"] for c in ("m", "y")]
    assert r2 == [pytest.approx(0.0), 1.0]


def test_perfect_scores_have_area_one(spark):
    df = spark.range(1000).select((F.col("id") >= 400).cast("int").alias("y"), F.col("id").cast("double").alias("s"), F.lit(0.5).alias("same"))
    assert metrics.roc_auc(df, "y", "s").first()["auc"] == 1.0
    assert metrics.roc_auc(df, "y", "same").first()["auc"] == 0.5
    points = metrics.roc_points(df, "y", "same").orderBy(F.desc("threshold")).collect()
    assert [(p["fpr"], p["tpr"]) for p in points] == [(0.0, 0.0), (1.0, 1.0)]


def test_line_is_recovered(spark):
    df = spark.range(50).select((F.col("id") / 50).alias("x")).withColumn("y", F.lit(0.7) * F.col("x") + F.lit(0.3))
    model = LinearRegression().fit(models.assembled(df, ["x"], "y"))
    assert model.coefficients[0] == pytest.approx(0.7, abs=1e-6) and model.intercept == pytest.approx(0.3, abs=1e-6)


def test_importances_and_saved_model(spark, tmp_path):
    df = spark.range(400).select(F.col("id").cast("double").alias("a"), F.rand(1).alias("b")).withColumn("y", 2 * F.col("a"))
    data = models.assembled(df, ["a", "b"], "y")
    model = RandomForestRegressor(numTrees=5, seed=1).fit(data)
    weights = dict(models.named_weights(model, ["a", "b"]))
    assert sum(weights.values()) == pytest.approx(1.0) and weights["a"] > weights["b"]
    models.save_model(model, str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    assert rows(again.transform(data), "prediction") == rows(model.transform(data), "prediction")


def test_search_and_sweep(spark):
    df = spark.range(200).select("id", F.array(F.col("id") / 200.0).alias("v"), (F.col("id") >= 100).cast("double").alias("label"))
    data = df.select("id", models.vector_of("v").alias("features"), "label")
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    scorer = MulticlassClassificationEvaluator(metricName="accuracy")
    forest = RandomForestClassifier(seed=1)
    grid = models.grid_of({forest.numTrees: [1, 3], forest.maxDepth: [1, 2]})
    drawn = models.drawn_from(grid, 2)
    assert len(drawn) == 2 and models.drawn_from(grid, 2) == drawn
    _, table = models.cross_scores(forest, drawn, data, scorer, ["id"], folds=2)
    assert table.count() == 2 and table.agg(F.min("score")).first()[0] > 0.8
    assert models.sweep(forest, forest.numTrees, [1, 2], data, data, scorer).count() == 2
    scored = models.with_probability(LogisticRegression().fit(data).transform(data), ["label"])
    assert scored.where("pred_prob < 0.5 OR pred_prob > 1").count() == 0
    assert models.forest_regressor(40_000, 10_000).getSubsamplingRate() == 0.25
    assert models.forest_regressor().getSubsamplingRate() == 1.0


@pytest.mark.parametrize("block", [7, 1000])
def test_neighbours_equal_brute_force(spark, block):
    rng = np.random.default_rng(0)
    points = rng.integers(0, 4, size=(60, 3)).astype(float)
    df = spark.createDataFrame([(i, [float(x) for x in p], int(i % 3)) for i, p in enumerate(points)], "id long, v array<double>, y int")
    found = {}
    for r in neighbours.nearest(df, df, "id", "v", "y", 4, skip_self=True, block_rows=block).collect():
        found.setdefault(r["query"], {})[r["rank"]] = r["neighbour"]
    for i in range(60):
        distance = ((points - points[i]) ** 2).sum(axis=1)
        order = [j for j in np.lexsort((np.arange(60), distance)) if j != i][:4]
        assert [found[i][k] for k in (1, 2, 3, 4)] == order


def test_codes_and_later_tables(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", None), (None, 3.0), ("b", 8.0)], "c string, n double")
    later = spark.createDataFrame([("a", None), ("zz", 5.0), (None, 1.0)], "c string, n double")
    fitted = features.Preparation.fit(train, ["n"], ["c"])
    assert rows(fitted.transform(later), "c", "c_is_missing", "n", "n_is_missing") == [(0, False, 5.0, False), (0, True, 1.0, False), (1, False, 3.0, True)]
    assert features.with_nulls(train, ["c", "n"]) == ["c", "n"]
    encode = features.ordinal_codes(train.dropna(), ["c"])
    assert rows(encode(later), "c", "c_code") == [("a", -1.0), ("zz", -1.0), (None, -1.0)]
    hot = features.one_hot(spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 0.0)], "c string, n double"), ["c"], ["n"])
    seen = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("zz", 5.0), (None, 3.0)], "c string, n double")
    assert sorted(list(r["features"].toArray()) for r in hot(seen).collect()) == [[0, 0, 3], [0, 0, 5], [0, 1, 2], [1, 0, 1]]


def test_splits_are_disjoint_and_cover(spark):
    df = spark.range(1000)
    parts = features.seeded_split(df, ["id"], 0.2, 42)
    assert rows(parts.groupBy("part").count()) == [("part", 200), ("rest", 800)] and parts.select("id").distinct().count() == 1000
    named = df.select(features.hashed_split(["id"], {"a": 0.5, "b": 0.5}, 1).alias("p")).groupBy("p").count()
    assert sum(r["count"] for r in named.collect()) == 1000 and all(400 < r["count"] < 600 for r in named.collect())
    cut = features.ordered_split(df, ["id"], 0.8)
    assert cut.where("part = 'train'").agg(F.max("id")).first()[0] == 799


def test_bigram_table(spark):
    words = spark.createDataFrame([("ab", 2), ("b", 1)], "word string, n long")
    pairs = text.pair_counts(words)
    assert rows(pairs) == [(".", "a", 2), (".", "b", 1), ("a", "b", 2), ("b", ".", 3)]
    table = text.transition_table(pairs)
    sums = [r[0] for r in table.groupBy("c1").agg(F.sum("p")).select("sum(p)").collect()]
    assert table.count() == 9 and sums == pytest.approx([1.0] * 3)
    unseen = spark.createDataFrame([("ba", 1)], "word string, n long")
    raw = text.transition_table(pairs, smoothing=0)
    assert text.negative_log_likelihood(unseen, raw).first()["nll"] == float("inf")
    sparse = text.transition_probabilities(pairs)
    assert sparse.count() == 4 + 3 and sparse.where("c2 IS NULL").count() == 3
    for table_ in (sparse, table):
        found = text.negative_log_likelihood(unseen.unionByName(words), table_)
        assert rows(found.select("word", F.round("nll", 9))) == rows(text.negative_log_likelihood(unseen.unionByName(words), table).select("word", F.round("nll", 9)))
    assert rows(text.vocabulary(words)) == [(".", 0), ("a", 1), ("b", 2)]
    assert rows(text.context_examples(words.where("n = 2")), "context", "next") == [("...", "a"), ("..a", "b"), (".ab", ".")]


def test_scalars(spark):
    df = spark.createDataFrame([("$4,000.00", "Hello heLLo", 7), ("$1.50", "", 8)], "price string, s string, d int")
    out = df.select(
        scalars.money_to_int(F.col("price")).alias("m"), scalars.count_character(F.col("s"), "L").alias("n"),
        scalars.drop_last(F.col("s"), 2).alias("cut"), scalars.variance_rag(F.col("d")).alias("rag"),
        scalars.variance_rag(F.lit(None).cast("int")).alias("none"),
    )
    assert rows(out) == [(150, 0, "", "Amber", ""), (400000, 4, "Hello heL", "Green", "")]
    soft = spark.range(1).select(arrays.softmax(F.array(F.lit(1000.0), F.lit(1000.0), F.lit(0.0))).alias("p")).first()["p"]
    assert soft == pytest.approx([0.5, 0.5, 0.0])
    sort = spark.range(1).select(arrays.argsort(F.array(F.lit(3), F.lit(1), F.lit(2))).alias("a")).first()["a"]
    assert sort == [1, 2, 0]


def test_a_prepared_chain_outlives_its_session_folder(spark, tmp_path):
    """Fitted, saved, and read again after all passing copies are gone; the estimator itself can be kept too."""
    import shutil

    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from lakeops.durable import shared_folder
    from lakeops.ml.prepare import Prepare, Prepared
    train = spark.createDataFrame([("b", 1.0, 2.0), ("a", None, 3.0), (None, 3.0, 5.0), ("b", 8.0, 1.0)], "c string, n double, label double")
    later = spark.createDataFrame([("a", None, 0.0), ("zz", 5.0, 0.0), (None, 1.0, 0.0)], "c string, n double, label double")
    chain = Pipeline(stages=[Prepare(numeric=["n"], categories=["c"]), VectorAssembler(inputCols=["n", "c"], outputCol="features"), LinearRegression()])
    chain.write().save(str(tmp_path / "unfitted"))
    fitted = Pipeline.load(str(tmp_path / "unfitted")).fit(train)
    wanted = rows(fitted.transform(later), "c", "c_is_missing", "n", "n_is_missing", "prediction")
    assert [r[:4] for r in wanted] == [(0, False, 5.0, False), (0, True, 1.0, False), (1, False, 3.0, True)]
    fitted.write().save(str(tmp_path / "fitted"))
    fitted.write().overwrite().save(str(tmp_path / "fitted"))
    for made in Path(shared_folder(spark)).glob("*"):
        shutil.rmtree(made)
    again = PipelineModel.load(str(tmp_path / "fitted"))
    assert isinstance(again.stages[0], Prepared) and again.stages[0].preparation.fills == {"n": 3.0}
    assert rows(again.transform(later), "c", "c_is_missing", "n", "n_is_missing", "prediction") == wanted
    # without codes there is no dictionary
    Prepare(numeric=["n"]).fit(train).write().save(str(tmp_path / "plain"))
    assert Prepared.load(str(tmp_path / "plain")).transform(later).columns == ["c", "n", "label", "n_is_missing"]


def test_sums_of_folds_equal_fits_on_their_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3)) * [1, 10, 100]
    y = x @ [2.0, -1.0, 0.1] + rng.normal(size=400) + 7
    data = [(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))] + [(900, None, 1.0, 1.0, 1.0), (901, 1.0, 1.0, 1.0, None)]
    df = models.with_fold(spark.createDataFrame(data, "id long, a double, b double, c double, y double"), ["id"], 4, 42)
    fold = {r["id"]: r["fold"] for r in df.collect()}
    got = {(r["penalty"], r["fold"]): r for r in gram.cross_scores(df.drop("fold"), ["a", "b", "c"], "y", ["id"], [0.0, 50.0], folds=4).collect()}
    of = np.array([fold[i] for i in range(400)])
    for (penalty, f), r in got.items():
        tx, ty = x[of != f], y[of != f]
        centred = tx - tx.mean(axis=0)
        w = np.linalg.solve(centred.T @ centred + penalty * np.eye(3), centred.T @ (ty - ty.mean()))
        told = (x[of == f] - tx.mean(axis=0)) @ w + ty.mean()
        own = y[of == f]
        assert r["n"] == (of == f).sum() and abs(r["r2"] - (1 - ((own - told) ** 2).sum() / ((own - own.mean()) ** 2).sum())) < 1e-8
    assert len(got) == 8
    table = gram.sweep(df.withColumn("part", F.when(F.col("id") < 300, "train").otherwise("test")), "part", ["a"], "y", [0.0])
    assert {r["part"]: r["n"] for r in table.collect()} == {"train": 300, "test": 100}
    assert gram.cross_scores(df.limit(0).drop("fold"), ["a"], "y", ["id"], [0.0]).count() == 0


TEXTS = ["Ab cd, AB\tcd!", "", None, "  zwei\nZeilen \u00dc\u00e9 7 ", "A", "x" * 40 + " \u4e2d\u6587 ..."]


@pytest.fixture
def labelled(spark, tmp_path):
    """A folder of a few texts and their labels; the quality hangs on the marks."""
    texts = TEXTS + ["good words here " * (3 + i % 9) if i % 3 else "bad! #$% " * (2 + i % 7) for i in range(90)]
    documents = [(i, text, "en" if i % 2 else "de", "web", None if text is None else len(text)) for i, text in enumerate(texts)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(bool(i % 3)), 0) for i in range(len(texts)) if i != 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return Tables(spark, str(tmp_path))


def test_counts_are_written_and_fits_read_no_text(labelled):
    """What the fits go over again and again is still there when the texts are gone."""
    frames = catalog.documents(labelled), catalog.counted_documents(labelled), catalog.lengths(labelled)
    shutil.rmtree(f"{labelled.folder}/documents.parquet")
    shutil.rmtree(f"{labelled.folder}/labels.parquet")
    assert [f.count() for f in frames] == [94, 95, 95]
    found = {r["doc_id"]: r for r in frames[1].collect()}
    assert 4 not in found and found[2]["marks"] is None and found[2]["n_chars"] is None
    for i, text in enumerate(TEXTS):
        if text is None or i not in found:
            continue
        words, of = re.split(r"\s+", text.strip(" ").lower()), max(len(text), 1)
        marks = sum(not (c.isalpha() or c in " \t\n") for c in text)
        capitals = sum("A" <= c <= "Z" for c in text)
        wanted = [len(text), len(words), text.count("\n") + 1, len(text) / len(words), marks / of, capitals / of, len(set(words)) / len(words)]
        assert [found[i][c] for c in catalog.DOCUMENT_COLUMNS] == pytest.approx(wanted), text


@pytest.mark.parametrize("name, rows", [("linear_svm", 1), ("random_search", 12), ("fit_and_score", 3), ("boosted_regression", 1)])
def test_texts_are_counted_once_a_query(labelled, monkeypatch, name, rows):
    """One count of the texts serves all fits, folds and scores of a query, and its result needs no other."""
    counted, count = [], catalog.with_counts
    monkeypatch.setattr(catalog, "with_counts", lambda documents: counted.append(1) or count(documents))
    made = getattr(catalog, name)(labelled)
    shutil.rmtree(f"{labelled.folder}/documents.parquet")
    assert made.count() == rows and counted == [1]


def test_only_labelled_texts_are_counted(labelled, monkeypatch):
    given, count = [], catalog.with_counts
    monkeypatch.setattr(catalog, "with_counts", lambda documents: given.append(documents.count()) or count(documents))
    assert catalog.counted_documents(labelled).count() == 95 and given == [95]


def test_likely_matches_keep_every_match_and_shuffle_no_row(spark):
    wide = spark.range(4000).select(F.when(F.col("id") % 10 > 0, F.col("id") % 2000).alias("k"), F.repeat(F.lit("x"), 50).alias("text"))
    keys = spark.range(500).select(F.when(F.col("id") > 0, F.col("id") * 3 + 1 - 1000).cast("int").alias("k"))
    keys = keys.unionByName(keys)
    found = joins.likely_matches(wide, keys, "k")
    wanted = wide.join(keys.distinct(), "k", "left_semi")
    assert found.columns == ["k", "text"] and rows(found.join(keys.distinct(), "k", "left_semi")) == rows(wanted)
    assert wanted.count() <= found.count() <= wanted.count() + 5 and found.where("k IS NULL").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    assert joins.likely_matches(wide, keys.limit(0), "k").count() == 0
    every = joins.likely_matches(spark.range(200_000), spark.range(0, 200_000, 2), "id")
    assert every.where("id % 2 = 0").count() == 100_000 and every.count() < 101_000


def test_models_are_fitted_side_by_side(spark):
    """Each fit waits until the other has begun; a row a model, in the order given, a thread's properties its own."""
    both, seen = threading.Barrier(2, timeout=60), {}

    class Fit:
        def __init__(self, name, score):
            self.name, self.score = name, score

        def fit(self, train):
            both.wait()
            seen[self.name] = train.sparkSession.sparkContext.getLocalProperty("caller")
            train.sparkSession.sparkContext.setLocalProperty("caller", self.name)
            both.wait()
            assert train.count() == 7 and train.sparkSession.sparkContext.getLocalProperty("caller") == self.name
            return self

        def transform(self, test):
            return test.withColumn("score", F.lit(self.score))

    class Score:
        def evaluate(self, df):
            return df.agg(F.avg("score")).first()[0]
    spark.sparkContext.setLocalProperty("caller", "test")
    try:
        found = models.fit_and_score({"b": Fit("b", 1.0), "a": Fit("a", 0.5)}, spark.range(7), spark.range(3), Score())
        assert [tuple(r) for r in found.collect()] == [("b", 1.0), ("a", 0.5)] and seen == {"a": "test", "b": "test"}
        assert spark.sparkContext.getLocalProperty("caller") == "test"
    finally:
        spark.sparkContext.setLocalProperty("caller", None)


def test_flags_follow_the_first_table(spark):
    train = spark.createDataFrame([(1.0, None), (3.0, 4.0)], "a double, b double")
    later = spark.createDataFrame([(None, 2.0)], "a double, b double")
    fitted = features.Preparation.fit(train, ["a", "b"], [])
    assert fitted.transform(later).columns == fitted.transform(train).columns == ["a", "b", "b_is_missing"]
    assert fitted.transform(later).first()["a"] == 2.0


def test_far_chunks_are_not_sent_and_far_tiles_not_searched(spark, monkeypatch):
    """Of well separated groups a query meets its own only, and the result is that of comparing all."""
    rng = np.random.default_rng(3)
    points = np.array([rng.normal(size=6) + 1000 * (i % 8) for i in range(1600)])
    df = spark.createDataFrame([(i, [float(x) for x in p], str(i % 8)) for i, p in enumerate(points)], "id long, v array<double>, label string")
    sent, whole = [], neighbours._further

    def counting(*a):
        found = whole(*a)
        sent.append((found.count(), len(a[1]) * len(a[2])))
        return found
    monkeypatch.setattr(neighbours, "_further", counting)
    got = neighbours.nearest(df, df, "id", "v", "label", 3, skip_self=True, block_rows=100)
    assert got.count() == 4800 and got.where("label <> query % 8").count() == 0
    pairs, possible = sent[0]
    assert possible >= 200 and pairs <= possible / 4
    found = {(r["query"], r["rank"]): r["neighbour"] for r in got.collect()}
    for i in range(0, 1600, 97):
        distance = ((points - points[i]) ** 2).sum(axis=1)
        assert [found[i, k] for k in (1, 2, 3)] == [j for j in np.lexsort((np.arange(1600), distance)) if j != i][:3]
    *_, skipped = neighbours.search(points, np.arange(1600), points, np.arange(1600), 3, np.full(1600, np.inf), True, tile=50)
    assert skipped > 0.8


def test_share_of_tiles_skipped_on_the_given_vectors(t):
    """The given vectors point in all directions alike: no tile can be skipped, and the search finds the same."""
    given = sorted(t.embeddings.select("vec_id", "embedding").collect())
    points, ids = np.array([r[1] for r in given], float), np.array([r[0] for r in given])
    q, r, d, skipped = neighbours.search(points, ids, points, ids, 5, np.full(len(ids), np.inf), True, tile=25)
    assert skipped == 0 and len(q) == 5 * len(ids)
    for i in range(0, len(ids), 37):
        distance = ((points - points[i]) ** 2).sum(axis=1)
        assert r[q == i].tolist() == [j for j in np.lexsort((ids, distance)) if j != i][:5]


def test_neighbours_of_copies_and_few_rows(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0], "a") for i in range(50)] + [(60, [5.0, 5.0], "b")], "id long, v array<double>, label string")
    got = neighbours.nearest(df, df, "id", "v", "label", 2, skip_self=True, block_rows=7)
    found = {r["query"]: [] for r in got.collect()}
    for r in got.orderBy("query", "rank").collect():
        found[r["query"]].append(r["neighbour"])
    assert found[0] == [1, 2] and found[7] == [0, 1] and found[60] == [0, 1]
    one = df.where("id = 0")
    assert neighbours.nearest(one, one, "id", "v", "label", 2, skip_self=True).count() == 0
    assert neighbours.nearest(one.limit(0), one, "id", "v", "label", 2).count() == 0
