"""Linear fits from sums of products: one scan serves all folds, parts and penalties.

Every group of rows is reduced to the products of its columns with each other, a square of
numbers whose side is the number of columns. Sums of groups are the sums of their rows, so the fit
on all folds but one, and its error on that fold, need no rows any more.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.ml.models import with_fold


@dataclass(frozen=True)
class Sums:
    """Products of a constant one, the features and the label with each other, summed over some rows."""

    products: np.ndarray

    @property
    def rows(self) -> int:
        return round(self.products[0, 0])

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.products + other.products)

    def __sub__(self, other: Sums) -> Sums:
        return Sums(self.products - other.products)

    def fit(self, penalty: float = 0.0) -> np.ndarray:
        """Intercept and weights with the least squared error plus ``penalty`` times the squared weights."""
        p, n = self.products, max(self.rows, 1)
        means = p[0, 1:] / n
        centred = p[1:, 1:] - n * np.outer(means, means)
        d = len(centred) - 1
        weights = np.linalg.lstsq(centred[:d, :d] + penalty * np.eye(d), centred[:d, d], rcond=None)[0]
        return np.concatenate([[means[d] - weights @ means[:d]], weights])

    def squared_error(self, fitted: np.ndarray) -> float:
        at = np.append(fitted, -1.0)
        return float(at @ self.products @ at)

    def r2(self, fitted: np.ndarray) -> float | None:
        """1 for a perfect fit, 0 for the mean of these rows; null where the label does not vary."""
        p = self.products
        spread = p[-1, -1] - p[0, -1] ** 2 / p[0, 0] if self.rows else 0.0
        return float(1 - self.squared_error(fitted) / spread) if spread > 0 else None


def sums_by(df: DataFrame, group: str, features: list[str], label: str) -> dict:
    """The sums of each group, in one scan; rows that lack a value are left out. A row a group reaches the driver."""
    names = [*features, label]
    whole = df.select(group, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names, 1)]).dropna(
        subset=[f"x{i}" for i in range(1, len(names) + 1)]).withColumn("x0", F.lit(1.0))
    side = len(names) + 1
    pairs = [(i, j) for i in range(side) for j in range(i, side)]
    found = whole.groupBy(group).agg(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs]).collect()
    made = {}
    for r in found:
        products = np.zeros((side, side))
        for i, j in pairs:
            products[i, j] = products[j, i] = r[f"s{i}_{j}"]
        made[r[group]] = Sums(products)
    return made


def cross_scores(df: DataFrame, features: list[str], label: str, id_columns: list[str], penalties: Iterable[float], folds: int = 5, seed: int = 42) -> DataFrame:
    """``penalty``, ``fold``, its rows ``n`` and the ``r2`` there of the ridge fit on all other folds."""
    by_fold = sums_by(with_fold(df, id_columns, folds, seed), "fold", features, label)
    total = sum(by_fold.values(), Sums(np.zeros((len(features) + 2,) * 2)))
    rows = [(float(p), fold, own.rows, own.r2((total - own).fit(p))) for p in penalties for fold, own in sorted(by_fold.items())]
    return df.sparkSession.createDataFrame(rows, "penalty double, fold bigint, n bigint, r2 double")


def sweep(df: DataFrame, part: str, features: list[str], label: str, penalties: Iterable[float], train: str = "train") -> DataFrame:
    """``penalty``, ``part``, ``n`` and ``r2`` on every part of ridge fits on the part named ``train``."""
    parts = sums_by(df, part, features, label)
    none = Sums(np.zeros((len(features) + 2,) * 2))
    rows = [(float(p), name, own.rows, own.r2(parts.get(train, none).fit(p))) for p in penalties for name, own in sorted(parts.items())]
    return df.sparkSession.createDataFrame(rows, "penalty double, part string, n bigint, r2 double")
