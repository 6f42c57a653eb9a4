"""Feature preparation: missing values, codes, dates, splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.durable import materialize
from lakeops.functions.scalars import date_parts
from lakeops.operators.ordering import add_row_index, exact_quantiles
from lakeops.operators.ranking import fraction_mark, seeded_key
from lakeops.operators.skew import spread_join


def medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    return {c: q[0.5] for c, q in exact_quantiles(df, columns, [0.5]).items()}


def fill_numeric(df: DataFrame, fills: dict[str, float], flagged: list[str] | None = None) -> DataFrame:
    """Fill the nulls with the given values; ``flagged`` columns (all by default) get ``<column>_is_missing``."""
    flags = {f"{c}_is_missing": F.col(c).isNull() for c in (fills if flagged is None else flagged)}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fills.items()}
    return df.withColumns(flags).withColumns(filled)


def with_nulls(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns that hold a null, found in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c]]


def category_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, value, code`` with codes 1, 2, ... in the order of the values.

    All columns share one distinct and one numbering pass.
    """
    cell = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("cell")
    values = df.select(cell).select("cell.*").where("value IS NOT NULL").distinct()
    numbered = materialize(add_row_index(values, ["column", "value"], "at"), "dictionary")
    first = numbered.groupBy("column").agg(F.min("at").alias("first"))
    return numbered.join(first, "column").select("column", "value", (F.col("at") - F.col("first") + 1).alias("code"))


def apply_codes(df: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each column by its code; add ``<column>_is_missing``.

    Null gives 0, as does a value the dictionary does not know.
    """
    plain = df
    for c in columns:
        codes = dictionary.where(F.col("column") == c).select(
            F.col("value").alias("__value"), F.col("code").alias("__code")
        )
        keyed = df.withColumns({f"{c}_is_missing": F.col(c).isNull(), "__value": F.col(c).cast("string")})
        counted = plain.select(F.col(c).cast("string").alias("__value"))
        df = spread_join(keyed, codes, ["__value"], "left", counted=counted).withColumn(
            c, F.coalesce("__code", F.lit(0)).cast("bigint")
        ).drop("__value", "__code")
    return df


@dataclass
class Preparation:
    """Medians and dictionaries learned on one table, for use on later ones.

    A numeric column gets a missing flag when the first table had nulls in it, so
    every table prepared with it has the same columns.
    """

    date: str | None
    fills: dict[str, float]
    flagged: list[str]
    dictionary: DataFrame | None
    categories: list[str]

    @classmethod
    def fit(cls, df: DataFrame, numeric: list[str], categories: list[str], date: str | None = None) -> Preparation:
        dictionary = category_dictionary(df, categories) if categories else None
        return cls(date, medians(df, numeric), with_nulls(df, numeric), dictionary, categories)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.date:
            df = expand_date(df, self.date, self.date)
        df = fill_numeric(df, self.fills, self.flagged)
        return apply_codes(df, self.dictionary, self.categories) if self.categories else df


def expand_date(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Replace a date by its parts."""
    return df.withColumns(date_parts(F.col(column), prefix)).drop(column)


# more columns than this are no table any more
MOST_DUMMIES = 10_000


def dummy_columns(df: DataFrame, columns: str | list[str], values: dict[str, list] | None = None) -> DataFrame:
    """One boolean column per value in place of each of the columns, also where it is null.

    Without ``values`` they are those that occur, in order; too many raise an error.
    """
    columns = [columns] if isinstance(columns, str) else columns
    for c in columns:
        found = (values or {}).get(c)
        if found is None:
            held = df.select(c).where(F.col(c).isNotNull()).distinct().limit(MOST_DUMMIES + 1).collect()
            if len(held) > MOST_DUMMIES:
                raise ValueError(f"{c} has more than {MOST_DUMMIES} values")
            found = sorted(r[0] for r in held)
        df = df.withColumns({f"{c}_{v}": F.coalesce(F.col(c) == v, F.lit(False)) for v in found}).drop(c)
    return df


def ordinal_codes(train: DataFrame, columns: list[str], unknown: float = -1.0):
    """Codes 0, 1, ... in the order of the values of ``train``; returns a function for any table.

    The values stay a frame, however many they are. ``<column>_code`` is ``unknown`` for
    a value unseen in training and for null.
    """
    dictionary = materialize(category_dictionary(train, columns), "codes")

    def encode(df: DataFrame) -> DataFrame:
        for c in columns:
            codes = dictionary.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
            keyed = df.withColumn("__value", F.col(c).cast("string"))
            found = spread_join(keyed, codes, ["__value"], "left", counted=df.select(F.col(c).cast("string").alias("__value")))
            df = found.withColumn(
                f"{c}_code", F.coalesce((F.col("__code") - 1).cast("double"), F.lit(unknown))
            ).drop("__value", "__code")
        return df
    return encode


# beyond every code, so the encoder takes it as unknown
_UNKNOWN_PLACE = float((1 << 31) - 1)


def one_hot(train: DataFrame, categories: list[str], passed: list[str], output: str = "features"):
    """One-hot codes fitted on ``train``, other columns passed; returns a function for any table.

    A value unseen in training, or null, is all zeros. The values stay a frame; the
    encoder holds how many there are. A row with a null passed column is left out.
    """
    encode = ordinal_codes(train, categories, _UNKNOWN_PLACE)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_code" for c in categories], outputCols=[f"{c}_hot" for c in categories],
        handleInvalid="keep", dropLast=True,  # the last place is that of unknown values
    ).fit(encode(train.dropna(subset=categories)))
    assembler = VectorAssembler(inputCols=[*[f"{c}_hot" for c in categories], *passed], outputCol=output, handleInvalid="skip")
    return lambda df: assembler.transform(encoder.transform(encode(df)))


def one_hot_stages(categories: list[str], passed: list[str], output: str = "features") -> list:
    """Stages that one-hot the categories and pass other columns through, as parts of one chain.

    The chain holds the values of each column; ``one_hot`` serves columns with very many.
    """
    indexer = StringIndexer(
        inputCols=categories, outputCols=[f"{c}_index" for c in categories],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    )
    # the slot of unseen values is the last one; dropping it makes their row all zero
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in categories], outputCols=[f"{c}_hot" for c in categories], dropLast=True
    )
    assembler = VectorAssembler(
        inputCols=[*[f"{c}_hot" for c in categories], *passed], outputCol=output, handleInvalid="skip"
    )
    return [indexer, encoder, assembler]


def impute(df: DataFrame, constants: dict[str, object], means: list[str], median_columns: list[str]) -> DataFrame:
    """Fill groups of columns by constant, mean and exact median."""
    df = df.fillna(constants) if constants else df
    if means:
        found = df.agg(*[F.avg(c).alias(c) for c in means]).first()
        df = df.fillna({c: found[c] for c in means if found[c] is not None})
    fills = {c: v for c, v in medians(df, median_columns).items() if v is not None} if median_columns else {}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fills.items()})


def imputer_stage(columns: list[str], strategy: str = "mean") -> Imputer:
    """The same as a stage of a chain; its median is approximate."""
    return Imputer(inputCols=columns, outputCols=columns, strategy=strategy)


def hashed_split(id_columns: list[str], shares: dict[str, float], seed: int) -> Column:
    """The name of each row's part, from its seeded key; repeats, needs no shuffle."""
    key = seeded_key(id_columns, seed)
    names = list(shares)
    part, upto, bounds = F.lit(names[-1]), 0.0, []
    for name in names[:-1]:
        upto += shares[name]
        bounds.append((name, fraction_mark(upto)))
    for name, mark in reversed(bounds):
        part = F.when(key < mark, name).otherwise(part)
    return part


def ordered_split(df: DataFrame, order_by: list, fraction: float) -> DataFrame:
    """``part`` = train for the first ``int(fraction * n)`` rows, test for the others."""
    numbered = add_row_index(df, order_by, "__at")
    return _cut(numbered, fraction, "train", "test")


def seeded_split(df: DataFrame, id_columns: list[str], fraction: float, seed: int) -> DataFrame:
    """An exact-size random part and its rest, repeatable by the seed."""
    keyed = df.withColumn("__key", seeded_key(id_columns, seed))
    numbered = add_row_index(keyed, ["__key", *id_columns], "__at").drop("__key")
    return _cut(numbered, fraction, "part", "rest")


def _cut(numbered: DataFrame, fraction: float, first: str, rest: str) -> DataFrame:
    size = numbered.agg(F.count(F.lit(1)).alias("n")).scalar()
    inside = F.col("__at") < F.floor(size * F.lit(fraction))
    return numbered.withColumn("part", F.when(inside, first).otherwise(rest)).drop("__at")
