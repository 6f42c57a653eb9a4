import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.durable import materialize, shared_folder
from lakeops.operators.ordering import add_row_index, add_running_totals, exact_quantiles


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 8).withColumn("x", F.xxhash64("id"))
    out = add_row_index(df, ["x"], "i", start=3).orderBy("i").collect()
    assert [r["i"] for r in out] == list(range(3, 5003))
    assert [r["x"] for r in out] == sorted(r["x"] for r in out)


def test_row_index_of_equal_rows(spark):
    df = spark.range(0, 1000, 1, 8).select(F.lit(1).alias("x"))
    assert sorted(r["i"] for r in add_row_index(df, ["x"], "i").collect()) == list(range(1000))


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "x int")
    assert add_row_index(empty, ["x"]).count() == 0
    assert exact_quantiles(empty, ["x"], [0.5]) == {"x": {0.5: None}}


def test_running_totals(spark):
    df = spark.range(1, 2001).select("id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("v"))
    out = add_running_totals(df, [F.desc("id")], {"t": "v"}).orderBy(F.desc("id")).collect()
    total = 0
    for r in out:
        total += r["v"] or 0
        assert r["t"] == total


@pytest.mark.parametrize("kind", ["normal", "ties", "tiny"])
def test_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(1)
    values = {"normal": rng.normal(size=30_000), "ties": np.repeat([1.0, 2.0, 9.0], [10_000, 5, 9_000]), "tiny": np.array([3.0, 1.0])}[kind]
    df = spark.createDataFrame([(float(v), None) for v in values], "a double, b double").withColumn("c", -F.col("a"))
    found = exact_quantiles(df, ["a", "b", "c"], [0.0, 0.25, 0.5, 0.99, 1.0])
    for p in (0.0, 0.25, 0.5, 0.99, 1.0):
        assert found["a"][p] == pytest.approx(np.quantile(values, p))
        assert found["c"][p] == pytest.approx(np.quantile(-values, p))
        assert found["b"][p] is None


def test_quantiles_do_not_depend_on_the_sketch(spark, monkeypatch):
    """Brackets that miss their rank are widened."""
    monkeypatch.setattr("lakeops.operators.ordering._edges", lambda probs: [0.9 for _ in probs for _ in (0, 1)])
    df = spark.range(1001).select(F.col("id").cast("double").alias("a"))
    assert exact_quantiles(df, ["a"], [0.1, 0.5]) == {"a": {0.1: 100.0, 0.5: 500.0}}


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    copy = materialize(spark.range(5).withColumn("m", F.lit(None).cast("string")))
    assert copy.columns == ["id", "m"] and shared_folder(spark) in copy.inputFiles()[0]


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://somewhere"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (float("nan"),), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.0, 0.5, 1.0]) == {"x": {0.0: 1.0, 0.5: 2.0, 1.0: 3.0}}
    infinite = spark.createDataFrame([(float("-inf"),), (5.0,), (float("inf"),)], "x double")
    assert exact_quantiles(infinite, ["x"], [0.5]) == {"x": {0.5: 5.0}}


def test_quantiles_of_many_columns_take_one_scan(spark):
    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id AS DOUBLE) * 2 AS b")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": {0.5: 49.5}, "b": {0.5: 99.0}}


def test_positions_beyond_an_integer(spark, monkeypatch):
    from lakeops.operators import shape
    far = spark.createDataFrame([(0, 1), (2**40, 2)], "__at long, x int")
    monkeypatch.setattr(shape, "add_row_index", lambda df, order_by, name: df)
    assert sorted(map(tuple, shape.attach_by_position(far, ["x"], [7], "v").select("x", "v").collect())) == [(1, 7), (2, None)]
