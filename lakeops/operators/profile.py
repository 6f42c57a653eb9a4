"""Aggregates that describe a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.ordering import exact_quantiles
from lakeops.operators.shape import columns_of


def numeric_means(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mean of every numeric column, per key or over all rows."""
    columns = [c for c in columns_of(df, "numeric") if c not in (keys or [])]
    means = [F.avg(c).alias(f"{c}_mean") for c in columns]
    return df.groupBy(*keys).agg(*means) if keys else df.agg(*means)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column."""
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = df.agg(F.array(*stats).alias("rows")).select(F.inline("rows"))

    def quartile(p: float) -> Column:
        chosen = F.lit(None).cast("double")
        for c in columns:
            chosen = F.when(F.col("column") == c, F.lit(quartiles[c][p])).otherwise(chosen)
        return chosen

    return rows.withColumns({"q25": quartile(0.25), "q50": quartile(0.5), "q75": quartile(0.75)})


def column_profile(df: DataFrame) -> DataFrame:
    """Type, non-null count, null count and null ratio, one row per column, in one pass."""
    cells = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count(f.name).alias("non_null"),
            F.count_if(F.col(f.name).isNull()).alias("nulls"),
            F.try_divide(F.count_if(F.col(f.name).isNull()), F.count(F.lit(1))).alias("null_ratio"),
        )
        for f in df.schema
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each value (nulls left out)."""
    present = df.where(F.col(column).isNotNull())
    total = present.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = present.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / total)


def crosstab(df: DataFrame, rows: str, columns: str, values: list | None = None) -> DataFrame:
    """Counts of each pair of values, the second spread over columns; 0 where none."""
    pivoted = df.groupBy(rows).pivot(columns, values).agg(F.count(F.lit(1)))
    return pivoted.fillna(0)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows in each of ``bins`` equal ranges; the last one is closed above."""
    value = F.col(column).cast("double")
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    width = (high - low) / F.lit(float(bins))
    at = F.least(F.floor(F.try_divide(value - low, width)), F.lit(bins - 1))
    present = df.where(F.col(column).isNotNull())
    return present.groupBy(F.coalesce(at, F.lit(0)).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def group_difference(df: DataFrame, group: str, a, b, value: str) -> DataFrame:
    """Percent by which group ``b``'s mean differs from group ``a``'s."""
    means = df.agg(
        F.avg(F.when(F.col(group) == a, F.col(value))).alias("mean_a"),
        F.avg(F.when(F.col(group) == b, F.col(value))).alias("mean_b"),
    )
    change = (F.col("mean_b") - F.col("mean_a")) / F.col("mean_a") * 100
    return means.withColumn("percent_difference", change)


def ratio_of(df: DataFrame, group: str, a, b, values: list[str]) -> DataFrame:
    """Ratio of two groups' means of each column."""
    def mean(g, v):
        return F.avg(F.when(F.col(group) == g, F.col(v)))
    return df.agg(*[(mean(a, v) / mean(b, v)).alias(f"{v}_ratio") for v in values])
