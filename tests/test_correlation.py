import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeops.operators import correlation
from lakeops.operators.correlation import Moments, correlations


@pytest.fixture(params=["pairs", "blocks"])
def form(request, monkeypatch):
    if request.param == "blocks":
        monkeypatch.setattr(correlation, "FEW_COLUMNS", 0)


def as_square(df, columns):
    found = {(r["a"], r["b"]): r["r"] for r in df.collect()}
    assert len(found) == len(columns) ** 2
    return np.array([[np.nan if found[a, b] is None else found[a, b] for b in columns] for a in columns])


def test_many_columns_in_one_scan(spark, tmp_path):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(600, 12))
    values = base @ rng.normal(size=(12, 300)) + rng.normal(size=(600, 300)) + 1e6
    values[rng.random(values.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(300)]
    frame = pd.DataFrame(values, columns=names)
    plain = [[None if np.isnan(v) else float(v) for v in row] for row in values]
    spark.createDataFrame(plain, ", ".join(f"{n} double" for n in names)).repartition(7).write.parquet(str(tmp_path / "t"))
    df = correlations(spark.read.parquet(str(tmp_path / "t")), names)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", plan)) == 1
    np.testing.assert_allclose(as_square(df, names), frame.corr().to_numpy(), atol=1e-8)


def test_pairs_without_a_value(spark, form):
    rows = [(1.0, 5.0, None, 2.0), (2.0, 5.0, None, None), (3.0, 5.0, 1.0, 7.0), (None, 5.0, 2.0, 9.0)]
    names = ["x", "same", "few", "y"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(3)
    got = as_square(correlations(df, names), names)
    assert np.isnan(got[1]).all() and np.isnan(got[0, 2])  # no spread, one common row
    assert got[0, 3] == pytest.approx(1.0) and got[2, 3] == pytest.approx(1.0) and got[0, 0] == pytest.approx(1.0)


def test_empty_and_not_finite(spark, form):
    empty = spark.createDataFrame([], "x double, y int")
    assert [r["r"] for r in correlations(empty, ["x", "y"]).collect()] == [None] * 4
    df = spark.range(10).select("id", F.when(F.col("id") == 3, float("nan")).otherwise(F.col("id")).alias("odd"))
    found = {(r["a"], r["b"]): r["r"] for r in correlations(df, ["id", "odd"]).collect()}
    assert np.isnan(found["id", "odd"]) and found["id", "id"] == pytest.approx(1.0)


def test_merging_in_any_order():
    rng = np.random.default_rng(2)
    rows, held = rng.normal(size=(90, 4)) * 10 + 1e5, rng.random((90, 4)) < 0.7
    rows = np.where(held, rows, 0.0)
    whole = Moments.of(rows, held)
    a, b, c = (Moments.of(rows[i::3], held[i::3]) for i in range(3))
    none = Moments(np.zeros((6, 4, 4)))
    for merged in (a + b + c, none + (c + (b + a)), (a + none) + (b + c)):
        np.testing.assert_allclose(merged.values, whole.values, rtol=1e-9, atol=1e-6)
