"""Joins that stay spread when one key, or null, holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.durable import materialize

# a key with more rows than this is dealt out over several tasks, about this many in each
HOT_ROWS = 1_000_000
SAMPLED_ROWS = 10_000
# rows without a key match nothing and can be dealt out as finely as there are tasks
_ANYWHERE = (1 << 31) - 1


def hashable(df: DataFrame) -> list[str]:
    """The columns Spark can hash: all but maps."""
    return [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]


def hot_keys(rows: DataFrame, on: list[str], floor: int = HOT_ROWS) -> DataFrame | None:
    """The keys with more than about ``floor`` rows and the ``__parts`` to deal each into, or None.

    Counted on a share of the rows that still holds thousands of each hot key, from
    the key columns only. All such keys are taken, and a key has a part for each
    ``floor`` of its estimated rows. They are kept as a written frame, so Spark sees
    how large it is. Which keys are found decides how rows travel, never which rows
    there are.
    """
    share = min(1.0, SAMPLED_ROWS / floor)
    seen = rows.select(*on) if share == 1.0 else rows.select(*on).sample(share, seed=17)
    counts = seen.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > floor * share)
    parts = F.ceil(F.col("__rows") / F.lit(floor * share)).cast("bigint").alias("__parts")
    found = materialize(counts.select(*on, parts), "hot")
    return None if found.isEmpty() else found


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    floor: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join many ``rows`` to ``lookup`` (few rows per key) on equal keys.

    Whether a side is broadcast is left to Spark, which knows its size, at the latest
    when it has been computed. Without hot keys this is the plain join. With hot keys
    their rows are dealt out over as many parts as they need, and the few lookup rows
    of such a key are repeated once per part. ``counted`` is a cheaper frame with the
    same key counts. ``how`` is inner, left, left_semi or left_anti.
    """
    hot = hot_keys(rows if counted is None else counted, on, floor)
    if hot is None:
        return rows.join(lookup, on, how)
    # equal rows lie in several input partitions, so the partition splits them too
    dealt = F.xxhash64(*hashable(rows), F.spark_partition_id())
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    salt = F.when(no_key, F.pmod(dealt, F.lit(_ANYWHERE))).otherwise(F.pmod(dealt, F.coalesce("__parts", F.lit(1))))
    left = rows.join(hot, on, "left").withColumn("__salt", salt.cast("bigint"))
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("__parts", F.lit(1)) - 1)
    right = lookup.join(hot, on, "left").withColumn("__salt", F.explode(copies))
    return left.drop("__parts").join(right.drop("__parts"), [*on, "__salt"], how).drop("__salt")
