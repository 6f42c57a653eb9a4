"""Latest versions, ordinals, running sums, top rows and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.ordering import add_row_index, add_running_totals
from lakeops.operators.skew import HOT_ROWS, hot_keys, spread_join


def latest_per_key(df: DataFrame, keys: list[str], version: str, floor: int = HOT_ROWS) -> DataFrame:
    """All rows that carry the highest ``version`` of their key; ties are kept.

    That is ``dense_rank() = 1`` over the key, descending, with nulls last. Spark
    drops outranked rows before the shuffle, but ties of one key still meet in one
    task. So keys with very many rows are taken out: their highest version is found by
    an aggregate and joined back, and Spark sees from their written list how few they
    are, so that their rows need no shuffle.
    """
    by_version = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(version))

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__rank", F.dense_rank().over(by_version)).where("__rank = 1").drop("__rank")

    hot = hot_keys(df, keys, floor)
    if hot is None:
        return ranked(df)
    hot = hot.drop("__parts").withColumnsRenamed({k: f"__hot_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys])
    hot_rows = df.join(hot, same)
    last = hot_rows.groupBy(*hot.columns).agg(F.max(version).alias("__last"))
    kept = df.join(last, same).where(F.col(version).eqNullSafe(F.col("__last")))
    others = df.join(hot, same, "left_anti")
    return kept.select(*df.columns).unionByName(ranked(others))


def group_ordinals(df: DataFrame, column: str) -> DataFrame:
    """Ordinal of each row's value: ``ordinal`` from 0 ascending, ``reverse_ordinal`` from 1 descending.

    Only the distinct values are numbered.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    numbered = add_row_index(values, [column], "ordinal")
    size = numbered.agg(F.count(F.lit(1)).alias("n")).scalar()
    numbered = numbered.withColumn("reverse_ordinal", size - F.col("ordinal"))
    return spread_join(df, numbered, [column], "left")


def cumulative_by(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Running sum over the totals of each order value."""
    totals = df.groupBy(order).agg(F.sum(value).alias(value))
    return add_running_totals(totals, [order], {out: value})


def slots(df: DataFrame, group: str, first_seen: str, date: str, item: str) -> DataFrame:
    """Number the items 1, 2, ...: groups as first seen, then date, then name."""
    firsts = df.groupBy(group).agg(F.min(first_seen).alias("__first"))
    ordered = spread_join(df, firsts, [group])
    return add_row_index(ordered, ["__first", group, date, item], "slot", start=1).drop("__first")


def current_and_earlier(df: DataFrame, snapshot: str) -> DataFrame:
    """Flag the rows of the last snapshot; its date is a scalar subquery."""
    return df.withColumn("is_current", F.col(snapshot) == df.agg(F.max(snapshot)).scalar())


# up to so many rows are kept by each task and merged in one, beyond it rows are numbered
FEW_ROWS = 10_000
# the sketch's rank error is 1 / accuracy; the cut leaves room for several of them
_ACCURACY = 10_000
_MARGIN = 5 / _ACCURACY


def _number(df: DataFrame, column: str) -> Column | None:
    """A double that never falls as ``column`` rises, where its type has one."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    return None


def _cut(df: DataFrame, column: str, n: int, descending: bool) -> DataFrame:
    """The rows whose ``column`` may place them among the first ``n``; all where that cannot be told.

    A sketch gives a value a little beyond the n-th, and a count confirms that ``n`` rows lie before it.
    Nulls come first, or last when ``descending``.
    """
    value = _number(df, column)
    if value is None:
        return df
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.count(value).alias("present")).first()
    wanted = n if descending else n - (seen["rows"] - seen["present"])
    if wanted <= 0:
        return df.where(value.isNull())
    share = wanted / max(seen["present"], 1) + _MARGIN
    if share >= 1:
        return df
    mark = df.agg(F.percentile_approx(value, 1 - share if descending else share, _ACCURACY).alias("m")).first()["m"]
    before = df.where(value >= mark) if descending else df.where((value <= mark) | value.isNull())
    return before if before.agg(F.count(F.lit(1)).alias("n")).first()["n"] >= n else df


def first_rows(df: DataFrame, order_by: list, n: int = 5) -> DataFrame:
    """The first ``n`` rows of the order, in that order; all, if there are fewer.

    Few rows are kept by each task and merged in one. Of many, no task holds all: the rows beyond
    the n-th value of the leading column, if it is a number, a date or a time given by name,
    are left out, the others are sorted over all tasks and numbered. ``order_by`` must tell all rows
    apart, or the choice among equals at the end is one of several.
    """
    if n <= FEW_ROWS:
        return df.orderBy(*order_by).limit(n)
    near = _cut(df, order_by[0], n, False) if isinstance(order_by[0], str) else df
    return _numbered(near, order_by, n).orderBy(*order_by)


def last_rows(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """The last ``n`` rows of the order, given back in that order."""
    backwards = [F.desc(c) for c in order_by]
    tail = df.orderBy(*backwards).limit(n) if n <= FEW_ROWS else _numbered(_cut(df, order_by[0], n, True), backwards, n)
    return tail.orderBy(*order_by)


def _numbered(df: DataFrame, order_by: list, n: int) -> DataFrame:
    return add_row_index(df, order_by, "__at").where(F.col("__at") < n).drop("__at")


def seeded_key(id_columns: list[str], seed: int) -> Column:
    """A hex text per row that looks random but repeats for the same seed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in id_columns]))


def fraction_mark(fraction: float) -> str:
    """The hex text below which ``fraction`` of all seeded keys lie."""
    return f"{min(int(fraction * 16**8), 16**8 - 1):08x}"


def sample_fraction(df: DataFrame, id_columns: list[str], fraction: float, seed: int) -> DataFrame:
    """Each row is in or out by its own seeded key; needs no shuffle and repeats."""
    return df.where(seeded_key(id_columns, seed) < fraction_mark(fraction))


def sample_rows(df: DataFrame, id_columns: list[str], n: int, seed: int) -> DataFrame:
    """``n`` rows at random, repeatable: those with the smallest seeded keys, all if there are fewer.

    Many rows are found without sorting the table: rows are counted by the first four digits of
    their keys (65,536 counts reach the driver), those below the digits of the n-th key are taken,
    and only those that share its digits are sorted.
    """
    key = seeded_key(id_columns, seed)
    if n <= FEW_ROWS:
        return df.orderBy(key, *id_columns).limit(n)
    digits = F.substring(key, 1, 4)
    counts = sorted((r["digits"], r["n"]) for r in df.groupBy(digits.alias("digits")).agg(F.count(F.lit(1)).alias("n")).collect())
    taken = 0
    for at, rows in counts:
        if taken + rows > n:
            return df.where(digits < at).unionByName(_numbered(df.where(digits == at), [key, *id_columns], n - taken))
        taken += rows
    return df


def shuffled(df: DataFrame, id_columns: list[str], seed: int) -> DataFrame:
    """All rows in a random but repeatable order."""
    return df.orderBy(seeded_key(id_columns, seed), *id_columns)


def top_per(df: DataFrame, keys: list[str], by: str, tie: Column) -> DataFrame:
    """One row per key: the highest ``by``, among equals the highest ``tie``."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(by), tie)).alias("__best")
    return df.where(F.col(by).isNotNull()).groupBy(*keys).agg(best).select(*keys, "__best.*")
