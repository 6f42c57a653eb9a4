"""Keyed upserts and slowly changing dimensions as functions from frames to frames.

Plain Spark tables have no ``MERGE``. Each function here takes the target and the
batch and returns the new target, which the caller writes beside the old one and
swaps in (see ``lakeops.sinks.tables``).

The target is joined to the batch, and of the target only the keys that the batch
holds come back to tell which of its rows are new. Spark broadcasts the batch where
its size allows, and then does not shuffle the target.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.durable import materialize, materialize_measured
from lakeops.operators.joins import current_version, not_yet_loaded, unknown_keys
from lakeops.operators.ordering import add_row_index
from lakeops.operators.ranking import latest_per_key

# Fixed value: the end of a version that is still open.
OPEN_END = "9999-12-31T23:59:59"


class DuplicateKeys(ValueError):
    """The batch holds several rows for one key, so no single row can win."""


def require_unique(source: DataFrame, keys: list[str]) -> None:
    twice = source.dropna(subset=keys).groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise DuplicateKeys(f"several source rows for {twice[0].asDict()}")


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    load_ts: Column,
    created: str = "__CreatedOn",
    updated: str = "__UpdatedOn",
    check: bool = True,
) -> DataFrame:
    """The merged rows with ``__action``: keep, update or insert.

    A matched row takes every source column, keeps ``created`` and gets a new
    ``updated``; null keys match nothing and are inserted.
    """
    if check:
        require_unique(source, keys)
    audit = [c for c in (created, updated) if c in target.columns]
    values = [c for c in source.columns if c not in keys and c not in audit]
    batch = source.select(*keys, F.struct(F.lit(1).alias("__in"), *values).alias("__new"))

    def merged(c: str, old: Column) -> Column:
        """Column ``c`` of a row that has a batch row, ``old`` being the target's value."""
        if c == updated:
            return load_ts
        return F.col(f"__new.{c}") if c in values else old

    hit = F.col("__new").isNotNull()
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # rows without a key match nothing and pass around the joins
    kept = target.where(~no_key).join(batch.where(~no_key), keys, "left").select(
        *[F.when(hit, merged(c, F.col(c))).otherwise(F.col(c)).alias(c) for c in target.columns],
        F.when(hit, "update").otherwise("keep").alias("__action"),
    )
    passed = target.where(no_key).withColumn("__action", F.lit("keep"))
    # of the target only the keys that the batch holds come back
    matched = target.select(*keys).where(~no_key).join(source.select(*keys), keys, "left_semi")
    fresh = source.where(~no_key).join(matched, keys, "left_anti").unionByName(source.where(no_key))
    lacking = {c: F.lit(None).cast(target.schema[c].dataType) for c in target.columns if c not in (*fresh.columns, *audit)}
    added = fresh.withColumns({c: load_ts for c in audit}).withColumns(lacking)
    return kept.unionByName(passed).unionByName(added.select(*target.columns, F.lit("insert").alias("__action")))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], load_ts: Column, **options) -> DataFrame:
    """Update matched rows with all source columns and insert the rest."""
    return merge_actions(target, source, keys, load_ts, **options).drop("__action")


def action_measures() -> dict[str, Column]:
    """Inserted, updated, deleted and affected rows of a merge, as aggregates."""
    inserted, updated = F.count_if(F.col("__action") == "insert"), F.count_if(F.col("__action") == "update")
    return {
        "num_inserted_rows": inserted, "num_updated_rows": updated,
        "num_deleted_rows": F.count_if(F.col("__action") == "delete"), "num_affected_rows": inserted + updated,
    }


def affected_rows(actions: DataFrame) -> DataFrame:
    """The row counts of a merge that is only planned, as one row."""
    return actions.agg(*[c.alias(name) for name, c in action_measures().items()])


def write_merged(actions: DataFrame, write: Callable[[DataFrame], object]) -> dict[str, int]:
    """Hand the merged rows to ``write`` and return the row counts of the merge, which is computed once."""
    merged, counts = materialize_measured(actions, "actions", action_measures())
    write(merged.drop("__action"))
    return counts


def row_checksum(columns: list[str]) -> Column:
    """Checksum of a row in which a null counts, and counts at its place."""
    return F.xxhash64(*[
        part for c in columns for part in (F.col(c).isNull(), F.col(c))
    ])


def unknown_member(df: DataFrame, values: dict) -> DataFrame:
    """``df`` and one fixed member; columns not given are null."""
    one = df.sparkSession.range(1).select(*[
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema
    ])
    return df.unionByName(one)


def infer_members(dimension: DataFrame, facts: DataFrame, fact_key: str, key: str, defaults: dict[str, Column]) -> DataFrame:
    """The dimension and a default row for each key the facts use and it lacks."""
    missing = unknown_keys(facts, dimension, fact_key, key).withColumnRenamed(fact_key, key)
    rows = missing.select(*[
        F.col(c) if c == key
        else defaults.get(c, F.lit(None)).cast(dimension.schema[c].dataType).alias(c)
        for c in dimension.columns
    ])
    return dimension.unionByName(rows)


def number_after(df: DataFrame, order_by: list, name: str, highest: int) -> DataFrame:
    """New keys ``highest + 1, highest + 2, ...`` in the given order."""
    return add_row_index(df, order_by, name, start=highest + 1)


def highest(df: DataFrame, column: str) -> int:
    """The largest key so far, 0 when there is none (one value to the driver)."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("m")).first()["m"]


def scd1_source(
    cleaned: DataFrame, key: str, date: str, start: str, end: str, unknown: dict
) -> DataFrame:
    """The batch for a type 1 dimension: last partition per key, and the unknown member.

    Every row carries the bounds of the load's window.
    """
    window = cleaned.where((F.col(date) >= F.lit(start).cast("date")) & (F.col(date) < F.lit(end).cast("date")))
    flagged = window.withColumn("__UnknownFlag", F.lit(False))
    rows = latest_per_key(unknown_member(flagged, {**unknown, "__UnknownFlag": True}), [key], date)
    return rows.withColumns({
        "__WindowStartTime": F.lit(start).cast("timestamp"), "__WindowEndTime": F.lit(end).cast("timestamp"),
    })


def scd1_apply(
    target: DataFrame, cleaned: DataFrame, key: str, date: str, start: str, end: str, unknown: dict, load_ts: Column
) -> DataFrame:
    """The type 1 dimension after a batch of cleaned rows, which is computed once."""
    batch = materialize(scd1_source(cleaned, key, date, start, end, unknown), "batch")
    return upsert(target, batch, [key], load_ts)


# columns a type 2 dimension has besides its keys and business columns
SCD2_COLUMNS = [
    "ValidFromDt", "ValidToDt", "CurrInd", "InsertCheckSum", "UpdateCheckSum",
    "RecordCreatedDt", "RecordUpdatedDt", "SourceSystemCd", "LoadID",
]


def scd2_changes(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Each source row with ``RowAction`` (Insert, Update or None) against the current versions."""
    business = source.columns
    rows = source.withColumn("CheckSum", row_checksum(business))
    known = target.select(
        key, "CurrInd", "Ekid",
        F.col("UpdateCheckSum").alias("OldCheckSum"),
        F.col("InsertCheckSum").alias("FirstCheckSum"),
        F.col("RecordCreatedDt").alias("FirstCreatedDt"),
    )
    action = (
        F.when(F.col("Ekid").isNull(), "Insert")
        .when(F.col("CheckSum") != F.col("OldCheckSum"), "Update")
        .otherwise("None")
    )
    return current_version(rows, known, [key]).withColumn("RowAction", action)


def scd2_initial(source: DataFrame, key: str, load_id: str, load_ts: Column, system: str) -> DataFrame:
    """The first version of a type 2 dimension."""
    empty = source.select(
        F.lit(None).cast("bigint").alias("Skid"), F.lit(None).cast("bigint").alias("Ekid"), *source.columns
    ).where(F.lit(False))
    kinds = {"ValidFromDt": "timestamp", "ValidToDt": "timestamp", "CurrInd": "boolean",
             "InsertCheckSum": "bigint", "UpdateCheckSum": "bigint", "RecordCreatedDt": "timestamp",
             "RecordUpdatedDt": "timestamp", "SourceSystemCd": "string", "LoadID": "string"}
    empty = empty.withColumns({c: F.lit(None).cast(kinds[c]) for c in SCD2_COLUMNS})
    return scd2_apply(empty, source, key, load_id, load_ts, system)


def scd2_versions(
    target: DataFrame, source: DataFrame, key: str, load_id: str, load_ts: Column, system: str
) -> DataFrame:
    """What a batch makes of the current versions: those that stay, those that end, and new ones.

    New keys get a first version; changed keys get a new version and their current
    one ends a minute before it starts. A version this load already wrote is not
    written again. Keys that vanish from the source stay open. Ended versions come
    with ``CurrInd`` false; the history of the target is not part of the result.
    """
    require_unique(source, [key])
    business = source.columns
    changes = materialize(scd2_changes(target, source, key).where(F.col("RowAction") != "None"), "changes")
    changes = changes.withColumn("LoadID", F.lit(load_id))
    updates = not_yet_loaded(
        changes.where(F.col("RowAction") == "Update"),
        # all changes carry this load's id, so no other load's versions matter
        target.where(F.col("LoadID") == load_id).select("Ekid", "LoadID"), ["Ekid", "LoadID"],
    )
    added = updates.unionByName(changes.where(F.col("RowAction") == "Insert"))
    current = target.where("CurrInd")
    # the highest keys so far are on current rows, as a key's last version is never closed;
    # one numbering serves both keys: updates come first and have their Ekid
    last = current.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("Skid", "Ekid")]).first()
    numbered = add_row_index(added, [F.col("Ekid").asc_nulls_last(), key], "__at")
    n_updates = numbered.agg(F.count("Ekid").alias("n")).scalar()
    versions = numbered.select(
        (F.col("__at") + last["Skid"] + 1).alias("Skid"),
        F.coalesce(F.col("Ekid"), F.col("__at") - n_updates + last["Ekid"] + 1).alias("Ekid"),
        *business,
        load_ts.alias("ValidFromDt"),
        F.lit(OPEN_END).cast("timestamp").alias("ValidToDt"),
        F.lit(True).alias("CurrInd"),
        F.coalesce("FirstCheckSum", "CheckSum").alias("InsertCheckSum"),
        F.col("CheckSum").alias("UpdateCheckSum"),
        F.coalesce(F.col("FirstCreatedDt"), load_ts).alias("RecordCreatedDt"),
        load_ts.alias("RecordUpdatedDt"),
        F.lit(system).alias("SourceSystemCd"),
        "LoadID",
    )
    ended = updates.select("Ekid", F.lit(True).alias("__ends"))
    ends = F.coalesce(F.col("__ends"), F.lit(False))
    closing = F.try_subtract(load_ts, F.expr("INTERVAL '1' MINUTE"))
    kept = current.join(ended, "Ekid", "left").withColumns({
        "ValidToDt": F.when(ends, closing).otherwise(F.col("ValidToDt")),
        "CurrInd": ~ends,
    })
    return kept.select(*versions.columns).unionByName(versions)


def scd2_apply(
    target: DataFrame, source: DataFrame, key: str, load_id: str, load_ts: Column, system: str
) -> DataFrame:
    """The whole type 2 dimension after a batch; its history passes through without a join."""
    now = scd2_versions(target, source, key, load_id, load_ts, system)
    return target.where("NOT CurrInd").unionByName(now.select(*target.columns))
