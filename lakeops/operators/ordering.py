"""Whole-table order without a whole-table task.

A window without ``PARTITION BY`` sorts everything in one task. Here the table is
sorted over all tasks, every row keeps its place (sort partition, position), the
result is written once, and only one row per *sort partition* is turned into
offsets. Executors never hold more than a sort partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.durable import materialize
from lakeops.operators.skew import hashable

# monotonically_increasing_id() keeps the partition above bit 33, the position below
_POSITION_BITS = 33


def _place(df: DataFrame, order_by: list) -> DataFrame:
    # rows that are equal in the order are told apart by the input partition they
    # come from, so that a large group of copies is not sorted in one task
    tie = F.xxhash64(*hashable(df), F.spark_partition_id())
    placed = (
        df.withColumn("__tie", tie).orderBy(*order_by, "__tie").drop("__tie")
        .withColumn("__place", F.monotonically_increasing_id())
    )
    return materialize(placed, "ordered").withColumn(
        "__part", F.shiftright("__place", _POSITION_BITS)
    )


def _with_offsets(placed: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Add ``__before_<name>``: the total of all earlier sort partitions.

    The collected frame has one row per sort partition, so its size is the number
    of shuffle partitions, whatever the table holds.
    """
    per_part = placed.groupBy("__part").agg(*[c.alias(n) for n, c in totals.items()])
    rows = sorted(per_part.collect(), key=lambda r: r["__part"])
    befores = {n: [rows[0][n] * 0, *accumulate(r[n] for r in rows)] if rows else [] for n in totals}
    fields = ", ".join(f"__before_{n} {per_part.schema[n].dataType.simpleString()}" for n in totals)
    offsets = placed.sparkSession.createDataFrame(
        [(r["__part"], *(befores[n][i] for n in totals)) for i, r in enumerate(rows)],
        f"__part bigint, {fields}",
    )
    return placed.join(F.broadcast(offsets), "__part")


def add_row_index(df: DataFrame, order_by: list, name: str = "row_index", start: int = 0) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in the order of ``order_by``.

    ``order_by`` must tell all rows apart, or the numbering is one of several.
    """
    placed = _with_offsets(_place(df, order_by), {"rows": F.count(F.lit(1))})
    position = F.col("__place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    index = F.col("__before_rows") + position + F.lit(start)
    return placed.select(*df.columns, index.cast("bigint").alias(name))


def add_running_totals(df: DataFrame, order_by: list, totals: dict[str, str]) -> DataFrame:
    """Add running sums ``{new column: summed column}`` up to and including each row.

    ``df`` should hold one row per order value: aggregate first, so that equal
    values, however many, arrive as one row.
    """
    placed = _with_offsets(
        _place(df, order_by), {out: F.sum(F.coalesce(F.col(c), F.lit(0))) for out, c in totals.items()}
    )
    within = (
        Window.partitionBy("__part")
        .orderBy("__place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = [
        (F.col(f"__before_{out}") + F.sum(F.coalesce(F.col(c), F.lit(0))).over(within)).alias(out)
        for out, c in totals.items()
    ]
    return placed.select(*df.columns, *sums)


# the sketch's rank error is 1 / accuracy; the bracket leaves room for several of them
_ACCURACY = 10_000
_MARGIN = 5 / _ACCURACY


def _edges(probs: list[float]) -> list[float]:
    return [e for p in probs for e in (max(0.0, p - _MARGIN), min(1.0, p + _MARGIN))]


@dataclass
class _Wanted:
    """One quantile: the two ranks it lies between and the bracket that holds them."""

    column: str
    prob: float
    first: int
    second: int
    part: float
    low: float
    high: float
    below: int = 0


def _values_inside(df: DataFrame, wanted: list[_Wanted]) -> DataFrame:
    """``k, v, n``: each value inside bracket ``k`` and its rows, for all columns in one scan."""
    brackets: dict[str, list[int]] = {}
    for k, w in enumerate(wanted):
        brackets.setdefault(w.column, []).append(k)
    # a value goes on only with the brackets of its column that hold it
    hits = [
        F.when(F.col(c).between(wanted[k].low, wanted[k].high), F.struct(F.lit(k).alias("k"), F.col(c).alias("v")))
        for c, ks in brackets.items() for k in ks
    ]
    held = df.select(F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h"))
    return held.groupBy(F.col("h.k").alias("k"), F.col("h.v").alias("v")).agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float]
) -> dict[str, dict[float, float | None]]:
    """Exact, linearly interpolated quantiles of several columns at once.

    A sketch gives a narrow bracket around each quantile, one pass counts the rows
    below each bracket, and only the values inside are sorted. Repeated values are
    counted before the sort. A bracket that turns out to miss its rank is widened
    to the whole column, so the result never depends on the sketch. NaN counts as
    missing, as null does.
    """
    df = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    sketch = df.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(F.col(c), _edges(probs), F.lit(_ACCURACY)).alias(f"q{i}")
          for i, c in enumerate(columns)],
    ).first()
    wanted = []
    for i, c in enumerate(columns):
        for j, p in enumerate(probs):
            n = sketch[f"n{i}"]
            if n:
                at = (n - 1) * p
                edges = sketch[f"q{i}"]
                wanted.append(_Wanted(c, p, int(at), min(int(at) + 1, n - 1), at - int(at), edges[2 * j], edges[2 * j + 1]))
    result: dict[str, dict[float, float | None]] = {c: dict.fromkeys(probs) for c in columns}
    if not wanted:
        return result
    counts = df.agg(*[
        f.alias(f"{kind}{k}") for k, w in enumerate(wanted) for kind, f in (
            ("below", F.count_if(F.col(w.column) < w.low)),
            ("upto", F.count_if(F.col(w.column) <= w.high)),
        )
    ]).first()
    for k, w in enumerate(wanted):
        w.below = counts[f"below{k}"]
        if w.first < w.below or w.second >= counts[f"upto{k}"]:
            w.low, w.high, w.below = float("-inf"), float("inf"), 0
    values = _values_inside(df, wanted)
    running = add_running_totals(values, ["k", "v"], {"upto": "n"})
    sizes = {r["k"]: r["n"] for r in running.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    start, ranks = 0, {}
    for k, w in enumerate(wanted):
        ranks[k] = [start + r - w.below for r in (w.first, w.second)]
        start += sizes[k]
    # at most two rows per quantile reach the driver
    hits = running.select("v", F.explode(F.filter(
        F.array(*[F.lit(r).cast("bigint") for r in sorted({r for pair in ranks.values() for r in pair})]),
        lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")),
    )).alias("rank")).collect()
    at_rank = {r["rank"]: r["v"] for r in hits}
    for k, w in enumerate(wanted):
        low, high = (at_rank[r] for r in ranks[k])
        # between infinite values there is nothing to interpolate when the rank is whole
        result[w.column][w.prob] = low + w.part * (high - low) if w.part else low
    return result
