"""Blocked matrix products."""

import collections
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from lakeops.operators.matrix import matrix_product


def brute(a, b):
    left, right, out = collections.defaultdict(float), collections.defaultdict(float), {}
    for (i, k, v), held in [(x, left) for x in a] + [((j, k, v), right) for k, j, v in b]:
        if v is not None and k is not None:
            held[i, k] += v
    by_inner = collections.defaultdict(list)
    for (j, k), v in right.items():
        by_inner[k].append((j, v))
    for (i, k), x in left.items():
        for j, y in by_inner[k]:
            out[i, j] = out.get((i, j), 0.0) + x * y
    return out


def frames(spark, a, b, inner="string"):
    return (spark.createDataFrame(a, f"i string, k {inner}, v double").repartition(3),
            spark.createDataFrame(b, f"k {inner}, j int, v double").repartition(3))


def same(got, wanted):
    got = {(r["i"], r["j"]): r["v"] for r in got.collect()}
    assert got.keys() == wanted.keys()
    for cell, v in wanted.items():
        assert math.isclose(got[cell], v, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(v) and math.isnan(got[cell])), cell


@pytest.mark.parametrize("side, tile, share", [(512, 100_000, 0.9), (3, 20, 0.9), (2, 7, 0.05), (5, 1, 0.3)])
def test_equals_brute_force(spark, side, tile, share):
    rng = random.Random(side)
    a = [(f"r{i}", f"k{k}", rng.uniform(-1, 1)) for i in range(12) for k in range(15) if rng.random() < share]
    b = [(f"k{k}", j, rng.uniform(-1, 1)) for k in range(15) for j in range(9) if rng.random() < share]
    # one row and one inner index with many cells, repeated cells, nulls, cells that nothing meets
    a += [("hot", f"k{k}", 1.0) for k in range(15)] * 2 + [(None, "k1", 2.0), ("r1", None, 5.0), ("r1", "k2", None), ("alone", "nowhere", 1.0)]
    b += [("k3", 100 + j, 0.5) for j in range(30)] + [("k1", None, 3.0), (None, 1, 5.0), ("elsewhere", 1, 1.0), ("k2", 3, 0.0)]
    same(matrix_product(*frames(spark, a, b), side=side, tile_cells=tile), brute(a, b))


def test_values_that_are_not_finite_meet_only_their_own_cells(spark):
    a = [("x", 1, math.inf), ("x", 2, 1.0), ("y", 2, 2.0), ("z", 3, math.nan)]
    b = [(1, 1, 2.0), (2, 1, 3.0), (2, 2, 0.0), (3, 2, 1.0)]
    same(matrix_product(*frames(spark, a, b, "int")), brute(a, b))


def test_nothing_to_multiply(spark):
    for a, b in (([], []), ([("x", "k", 1.0)], []), ([("x", "k", 1.0)], [("l", 1, 1.0)])):
        got = matrix_product(*frames(spark, a, b))
        assert got.columns == ["i", "j", "v"] and got.count() == 0


def test_one_inner_index_is_dealt_out_over_the_result(spark):
    """A column times a row: one inner index for all cells, and four million results."""
    n = 2000
    ids = spark.range(n).withColumnRenamed("id", "i")
    a = ids.select("i", F.lit(7).alias("k"), (F.col("i") + 1).cast("double").alias("v"))
    b = ids.select(F.lit(7).alias("k"), F.col("i").alias("j"), F.lit(2.0).alias("v"))
    begun = time.monotonic()
    product = matrix_product(a, b)
    assert product.agg(F.count(F.lit(1)), F.sum("v")).first()[:] == (n * n, float(n * (n + 1) * n))
    assert time.monotonic() - begun < 30
    # each cell goes to as many blocks as the result has on its side, and no task has more than a block of it
    sizes = [r["count"] for r in product.select(F.pmod(F.xxhash64("i"), F.lit(4)).alias("r"), F.pmod(F.xxhash64("j"), F.lit(4)).alias("c")).groupBy("r", "c").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * n * n / 16
