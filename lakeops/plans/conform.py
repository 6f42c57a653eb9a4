"""Cleaned tables to conformed dimensions, with gates on the result."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.durable import materialize_measured, measured, passing_stages
from lakeops.operators import merge, quality
from lakeops.sinks import tables


# the load that ended a version; part of the layout, not of the dimension
BATCH = "__EndedBy"


def load_id_for(now: datetime) -> str:
    """Load id from the clock, used when the caller names none."""
    return now.strftime("%Y%m%d%H%M%S")


def conform_scd2(
    spark: SparkSession, table: str, root: str, source: DataFrame, key: str,
    load_id: str | None, load_ts: datetime, system: str, log_path: str,
) -> None:
    """Load a batch into a type 2 dimension table; without a ``load_id`` the load's time is it.

    The table has one partition of current versions and one of ended versions per
    load. A load writes the current versions and the ones it ends into a new folder,
    checks them, and only then lets the table read it: history is never rewritten.
    A rerun after a failure between the two last steps gives the same table.
    """
    load_id = load_id or load_id_for(load_ts)
    with passing_stages(spark):
        stamp = F.lit(load_ts).cast("timestamp")
        source, held = materialize_measured(source, "source")
        if spark.catalog.tableExists(table):
            target = spark.table(table).drop(BATCH)
            rows = merge.scd2_versions(target, source, key, load_id, stamp, system)
        else:
            target = None
            rows = merge.scd2_initial(source, key, load_id, stamp, system)
            shape = StructType([*rows.schema.fields, StructField(BATCH, StringType())])
            tables.create_if_absent(spark, table, shape, f"{root}/empty", ["CurrInd", BATCH])
        by_this_load = F.col("CurrInd") & (F.col("LoadID") == load_id)
        path = tables.write_version(rows, root, ["CurrInd"])
        new = spark.read.schema(rows.schema).parquet(path)
        seen = measured(new, {
            "current": F.count_if("CurrInd"), "ended": F.count_if(~F.col("CurrInd")),
            "first_new": F.min(F.when(by_this_load, F.col("Skid"))), "last_old": F.max(F.when(~by_this_load, F.col("Skid"))),
        })
        keys = quality.key_counts(new, ["Skid"]).first()
        shared = keys[0]
        # new keys come after all current ones, which end up in the history; where that does
        # not hold (an earlier load is run again) the keys of this load are looked up there
        if target is not None and seen["first_new"] is not None and seen["first_new"] <= (seen["last_old"] or 0):
            shared += target.where("NOT CurrInd").select("Skid").join(new.where(by_this_load).select("Skid"), "Skid", "left_semi").count()
        _gates(spark, table, log_path, load_ts, new, "Skid", (shared, keys[1]), (held["rows"], seen["current"]), path)
        if seen["ended"]:
            tables.point_partition(spark, table, {"CurrInd": "false", BATCH: load_id}, f"{path}/CurrInd=false")
        tables.point_partition(spark, table, {"CurrInd": "true", BATCH: "current"}, f"{path}/CurrInd=true")


def conform_scd1(
    spark: SparkSession, table: str, root: str, cleaned: DataFrame, key: str, date: str,
    start: str, end: str, unknown: dict, load_ts: datetime, log_path: str,
) -> None:
    """Load a window of cleaned rows into a type 1 dimension table."""
    with passing_stages(spark):
        stamp = F.lit(load_ts).cast("timestamp")
        # one value for each day of the window
        batch, held = materialize_measured(
            merge.scd1_source(cleaned, key, date, start, end, unknown), "batch", {"rows": F.count(F.lit(1)), "days": F.collect_set(date)}
        )
        if not spark.catalog.tableExists(table):
            shape = batch.withColumns({"__CreatedOn": stamp, "__UpdatedOn": stamp})
            tables.create_if_absent(spark, table, shape.schema, f"{root}/empty")
        target = spark.table(table)
        of_these_days = F.col(date).isin(held["days"]) | F.col(date).isNull()
        path = tables.write_version(merge.upsert(target, batch, [key], stamp), root)
        new = spark.read.schema(target.schema).parquet(path)
        seen = measured(new, {"rows": F.count_if(of_these_days)})
        _gates(spark, table, log_path, load_ts, new, key, quality.key_counts(new, [key]).first(), (held["rows"], seen["rows"]), path)
        tables.point_at(spark, table, path)


def _gates(spark, table, log_path, load_ts, new, key, keys, counts, path):
    """Key and count checks of a new version; both rows are logged before a failure raises.

    ``keys`` are the rows that share a key and the keys, ``counts`` the rows of the batch and of the
    table.
    """
    asset = {
        "NotebookName": "conform", "SourceDataAsset": table, "SourceDataAssetPath": path,
        "SchemaReference": new.schema.simpleString(),
    }
    key_entry = quality.checked(
        quality.PRIMARY_KEY, keys[0], keys[1], load_ts,
        PrimaryKeyChecked=key, **asset,
    )
    count_entry = quality.checked(
        quality.COUNT, counts[0], counts[1], load_ts,
        TargetDataAsset=table, TargetDataAssetPath=path, **asset,
    )
    tables.append_log(spark, [key_entry, count_entry], log_path)
    quality.require(keys[0] == 0, f"{table}: {keys[0]} rows share a key", key_entry)
    quality.require(counts[0] == counts[1], f"{table}: {counts[0]} rows in the batch, {counts[1]} in the table", count_entry)
