"""Set operations over frames and token sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def stack_runs(runs: dict[object, DataFrame], name: str = "run") -> DataFrame:
    """Many frames as one, each row tagged with its run."""
    tagged = [df.withColumn(name, F.lit(run)) for run, df in runs.items()]
    return reduce(DataFrame.unionByName, tagged)


def tokens(text: Column) -> Column:
    """The set of words of a text."""
    return F.array_distinct(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))


def shared_tokens(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_intersect(tokens(a), tokens(b)))


def unshared_tokens(a: Column, b: Column) -> Column:
    """Words in one text and not in the other."""
    left, right = tokens(a), tokens(b)
    return F.array_sort(F.array_union(F.array_except(left, right), F.array_except(right, left)))


def stack_dates(df: DataFrame, baseline: str, finish: str, name: str = "d") -> DataFrame:
    """All baseline dates, then the finish dates that differ from their baseline.

    A row with either date missing differs, as in pandas.
    """
    differs = ~F.coalesce(F.col(finish) == F.col(baseline), F.lit(False))
    return df.select(F.col(baseline).alias(name)).unionAll(
        df.where(differs).select(F.col(finish).alias(name))
    )
