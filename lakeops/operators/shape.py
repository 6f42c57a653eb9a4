"""Projections, filters and row shaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.ordering import add_row_index


def rename_trim(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select ``{source: target}`` columns, trimming the text ones."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        (F.trim(F.col(s)) if s in text else F.col(s)).alias(t) for s, t in names.items()
    ])


def add_audit_columns(df: DataFrame, start: Column, end: Column, load_ts: Column) -> DataFrame:
    """Window and audit columns; the load time is passed in so a rerun repeats it."""
    return df.withColumns({
        "__WindowStartTime": start,
        "__WindowEndTime": end,
        "__CreatedOn": load_ts,
        "__UpdatedOn": load_ts,
    })


def date_window(df: DataFrame, column: str, start: str, end: str | None = None) -> DataFrame:
    """Rows of the half-open window ``[start, end)``; one day when no end is given."""
    return df.where(in_date_window(column, start, end))


def in_date_window(column: str, start: str, end: str | None = None) -> Column:
    """Whether a date lies in the half-open window ``[start, end)``; one day when no end is given."""
    first = F.lit(start).cast("date")
    last = F.lit(end).cast("date") if end else F.date_add(first, 1)
    return (F.col(column) >= first) & (F.col(column) < last)


def any_pattern(column: str, patterns: list[str]) -> Column:
    """True where the text holds any of the regular expressions."""
    return reduce(lambda a, b: a | b, [F.col(column).rlike(p) for p in patterns])


def split_compliant(df: DataFrame, corrupt: str = "__corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, without the corrupt column, and those that do not."""
    return df.where(F.col(corrupt).isNull()).drop(corrupt), df.where(F.col(corrupt).isNotNull())


def align_columns(df: DataFrame, columns: list[str], default=False) -> DataFrame:
    """Exactly ``columns`` in order; the ones ``df`` lacks hold ``default``."""
    missing = missing_columns(columns, df.columns)
    return df.withColumns({c: F.lit(default) for c in missing}).select(*columns)


def missing_columns(wanted: list[str], present: list[str]) -> list[str]:
    """Names in ``wanted`` and not in ``present``, in their order."""
    have = set(present)
    return [c for c in wanted if c not in have]


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Column names of a kind: ``numeric``, ``string``, ``date`` or ``boolean``."""
    kinds = {
        "numeric": T.NumericType,
        "string": T.StringType,
        "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
        "boolean": T.BooleanType,
    }
    return [f.name for f in df.schema if isinstance(f.dataType, kinds[kind])]


def features_and_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(label), df.select(label)


def attach_by_position(df: DataFrame, order_by: list, values: list, name: str) -> DataFrame:
    """Add a column from a positional list; rows beyond its end get null."""
    indexed = add_row_index(df, order_by, "__at")
    held = F.array(*[F.lit(v) for v in values])
    # only a place inside the list is narrowed to an integer
    inside = F.when(F.col("__at") < len(values), F.col("__at")).cast("int")
    return indexed.withColumn(name, F.get(held, inside)).drop("__at")


def attach_series(df: DataFrame, order_by: list, series: DataFrame, series_order: list, name: str) -> DataFrame:
    """Add ``name`` of ``series`` to ``df``, row by row in the two given orders."""
    left = add_row_index(df, order_by, "__at")
    right = add_row_index(series, series_order, "__at").select("__at", name)
    return left.join(right, "__at", "left").drop("__at")
