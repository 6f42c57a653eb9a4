"""Joins of the load steps, totals by price and grids of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.skew import spread_join

# keys sent to tasks as one bit for each value of their hash: 4 MB whatever their number
BITS, PAGE = 1 << 25, 1 << 15


def inner_detail(rows: DataFrame, details: DataFrame, on: list[str]) -> DataFrame:
    """Inner join to a detail table with one row per key."""
    return spread_join(rows, details, on)


def code_lookup(rows: DataFrame, codes: DataFrame, on: list[str], keep: Column | None = None) -> DataFrame:
    """Left join to the codes that pass ``keep``; rows without one get nulls."""
    return spread_join(rows, codes if keep is None else codes.where(keep), on, "left")


def current_version(rows: DataFrame, dimension: DataFrame, on: list[str], current: str = "CurrInd") -> DataFrame:
    """Left join to the current version of each member."""
    return spread_join(rows, dimension.where(F.col(current)).drop(current), on, "left")


def unknown_keys(rows: DataFrame, dimension: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Distinct keys of ``rows`` that ``dimension`` lacks (null counts as unknown).

    Keys are made distinct before the join, so a hot key is one row there.
    """
    keys = rows.select(key).distinct()
    return keys.join(dimension.select(F.col(dim_key).alias(key)), key, "left_anti")


def not_yet_loaded(rows: DataFrame, target: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key tuple is not in the target: the guard for reruns."""
    return spread_join(rows, target.select(*on).distinct(), on, "left_anti")


def likely_matches(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """All rows whose key is in ``keys``, and the few others that share a bit with one; rows without a key go.

    For wide rows before costly work: only bits of bounded size are sent, so rows stay where they are.
    The join that rules out the others is to follow.
    """
    at = F.pmod(F.xxhash64(F.col(on).cast("string")), F.lit(BITS))
    page, bit = F.shiftright(at, PAGE.bit_length() - 1), F.pmod(at, F.lit(PAGE))
    pages = keys.where(F.col(on).isNotNull()).select(page.alias("__page"), bit.alias("__bit")).repartition("__page")
    pages = pages.groupBy("__page").agg(F.bitmap_construct_agg("__bit").alias("__bits"))  # at most BITS / PAGE rows of 4 KB
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    placed = rows.where(F.col(on).isNotNull()).withColumn("__page", page).join(F.broadcast(pages), "__page")
    return placed.where(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1).select(*rows.columns)


def of_batch_dates(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Target rows of the dates in the batch, and the ones without a date."""
    dates = batch.select(column).distinct()
    dated = spread_join(target, dates, [column], "left_semi")
    return dated.unionByName(target.where(F.col(column).isNull()))


def weighted_totals(
    quantities: DataFrame, prices: DataFrame, group: str, item: str, quantity: str, price: str
) -> DataFrame:
    """Per group, the sum of quantity times the item's price.

    Quantities are summed per (group, item) first, so the join sees one row each.
    """
    summed = quantities.groupBy(group, item).agg(F.sum(quantity).alias(quantity))
    # an item now has one row per group at most, so there are no hot items left to spread
    priced = summed.join(prices.select(item, price), item)
    return priced.groupBy(group).agg(F.sum(F.col(quantity) * F.col(price)).alias("total"))


def value_grid(df: DataFrame, x: str, y: str, steps: int) -> DataFrame:
    """All pairs of ``steps`` evenly spaced values between the extremes of two columns.

    One row of extremes is expanded twice; no table is joined to another.
    """
    low_high = df.agg(*[f(c).cast("double").alias(f"{c}_{n}") for c in (x, y)
                        for n, f in (("low", F.min), ("high", F.max))])

    def spaced(c: str, i: Column) -> Column:
        return F.col(f"{c}_low") + (F.col(f"{c}_high") - F.col(f"{c}_low")) * i / F.lit(float(steps - 1))

    index = F.sequence(F.lit(0), F.lit(steps - 1))
    rows = low_high.withColumn("i", F.explode(index)).withColumn("j", F.explode(index))
    return rows.select("i", "j", spaced(x, F.col("i")).alias(x), spaced(y, F.col("j")).alias(y))
