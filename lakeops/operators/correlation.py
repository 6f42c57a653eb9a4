"""Correlations of many columns from sums of their products.

Each task reduces its rows to squares of numbers whose side is the number of columns, with one matrix
product a batch. The squares are cut into bands of columns, and the bands of all tasks are merged
in a tree, so no task or group holds more than a fixed number of bands.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: columns of a band, and bands that are merged at a time
BAND = 16
FAN_IN = 256
#: up to so many columns each pair is an expression of one aggregate
FEW_COLUMNS = 16

_STATE = "part long, band int, state binary"


class Moments:
    """Of each column (down) with each (across): rows that hold both, the mean and squared deviations of
    the first over them, and the product of both deviations; as well the mean and deviations of the second."""

    def __init__(self, values: np.ndarray):
        """``values``: number, mean and deviations of the first, of the second, products, for each pair."""
        self.values = values

    @classmethod
    def of(cls, rows: np.ndarray, held: np.ndarray) -> Moments:
        """``rows`` has a row of values for each row of the table, 0 where ``held`` is false."""
        there = held.astype(float)
        low, high = (f(np.where(held, rows, missing), axis=0) for f, missing in ((np.min, np.inf), (np.max, -np.inf)))
        # a column that does not vary is shifted to 0 exactly
        shift = np.where(low == high, low, rows.sum(axis=0) / np.maximum(there.sum(axis=0), 1))
        x = np.where(held, rows - shift, 0.0)
        n, first, square = there.T @ there, x.T @ there, (x * x).T @ there
        mean = np.divide(first, n, out=np.zeros_like(n), where=n > 0)
        spread = square - n * mean * mean
        spread[spread < 1e-13 * square] = 0.0
        products = x.T @ x - n * mean * mean.T
        by_first = shift[:, None] + mean
        return cls(np.stack([n, by_first, spread, by_first.T, spread.T, products]))

    def __add__(self, other: Moments) -> Moments:
        n1, a1, s1, b1, t1, p1 = self.values
        n2, a2, s2, b2, t2, p2 = other.values
        n = n1 + n2
        share = np.divide(n2, n, out=np.zeros_like(n), where=n > 0)
        # a side without rows has no mean to differ from
        both = (n1 > 0) & (n2 > 0)
        da, db = np.where(both, a2 - a1, 0.0), np.where(both, b2 - b1, 0.0)
        a = np.where(n1 > 0, a1 + da * share, a2)
        b = np.where(n1 > 0, b1 + db * share, b2)
        weight = n1 * share
        return Moments(np.stack([n, a, s1 + s2 + da * da * weight, b, t1 + t2 + db * db * weight, p1 + p2 + da * db * weight]))

    def correlation(self) -> np.ndarray:
        """NaN where fewer than two rows hold both, or one does not vary."""
        n, _, s, _, t, p = self.values
        scale = np.sqrt(s) * np.sqrt(t)
        fine = (n > 1) & ((scale > 0) | np.isnan(scale))
        return np.divide(p, scale, out=np.full_like(p, np.nan), where=fine)


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    held = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
    rows = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
    return rows, held


def _by_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    # corr() itself fails on a column that does not vary
    def r(p: str, q: str) -> Column:
        x, y = F.col(p).cast("double"), F.col(q).cast("double")
        if p == q:
            return F.try_divide(F.var_pop(x), F.var_pop(x))
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)

    cells = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), r(p, q).alias("r"))
        for p, q in combinations_with_replacement(columns, 2)
        for x, y in ([(p, q)] if p == q else [(p, q), (q, p)])
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation of each pair of columns as ``(a, b, r)``, in one scan.

    Rows that lack one of a pair do not count for it. ``r`` is null where fewer than two rows are
    left or a column does not vary in them, also over an empty table, and NaN where a value is NaN or infinite.
    Few columns are pairs of expressions in one aggregate. Beyond ``FEW_COLUMNS``, whose pairs would be more
    expressions than can be compiled, a task sums blocks; it holds some 100 bytes for each pair, 9 MB for 300 columns.
    """
    width = len(columns)
    if width <= FEW_COLUMNS:
        return _by_pairs(df, columns)
    shape = (6, -1, width)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments(np.zeros((6, width, width)))
        part = None
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                if len(batch):
                    part = batch.column(0)[0].as_py()
                    total += Moments.of(*_matrix(batch.select(batch.schema.names[1:])))
        if part is not None:
            bands = range(0, width, BAND)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * len(bands), pa.int64()), "band": pa.array(bands, pa.int32()),
                "state": pa.array([np.ascontiguousarray(total.values[:, b:b + BAND]).tobytes() for b in bands], pa.binary()),
            })

    def merged(table: pa.Table) -> Moments:
        states = (Moments(np.frombuffer(s.as_py()).reshape(shape)) for s in table.column("state"))
        total = next(states)
        with np.errstate(invalid="ignore", over="ignore"):
            for other in states:
                total += other
        return total

    def merge(table: pa.Table) -> pa.Table:
        return table.slice(0, 1).set_column(2, "state", pa.array([merged(table).values.tobytes()], pa.binary()))

    def finish(table: pa.Table) -> pa.Table:
        total, first = merged(table), table.column("band")[0].as_py()
        infinite = ~np.isfinite(total.values[1:]).all(axis=0)
        with np.errstate(invalid="ignore", over="ignore"):
            r = total.correlation().ravel()
        own = columns[first:first + BAND]
        return pa.table({
            "a": pa.array(np.repeat(own, width), pa.string()), "b": pa.array(list(columns) * len(own), pa.string()),
            "r": pa.array(r, pa.float64(), mask=np.isnan(r) & ~infinite.ravel()),
        })

    # rows of a task carry its number; several batches of one are reduced together
    numbered = df.select(F.spark_partition_id().cast("long").alias("part"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    states = numbered.mapInArrow(reduce_rows, _STATE)
    # at most FAN_IN states of a band meet, then those of FAN_IN such groups
    partly = states.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("band", "part").applyInArrow(merge, _STATE)
    found = partly.groupBy("band").applyInArrow(finish, "a string, b string, r double")
    # an empty table has no states; its pairs are there all the same
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "a string")
    pairs = names.select("a", F.explode(F.array(*[F.lit(c) for c in columns])).alias("b"))
    return pairs.join(found, ["a", "b"], "left")
