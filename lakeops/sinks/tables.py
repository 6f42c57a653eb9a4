"""Tables on files: create, overwrite partitions, swap in a new version, append, export."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.durable import materialize_measured, measured, remove
from lakeops.operators.quality import DQ_LOG_SCHEMA


def create_if_absent(spark: SparkSession, table: str, schema: StructType, path: str, partitions: list[str] | None = None) -> None:
    """A parquet table with declared columns at ``path``, unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {by} LOCATION '{path}'")


# Fixed value: the folder of rows whose partition value is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def overwrite_partitions(
    df: DataFrame, path: str, partitions: list[str], tasks_per_partition: int | None = None, measures: dict[str, Column] | None = None
) -> dict:
    """Replace only the partitions that ``df`` holds; returns the ``measures`` asked for, of the rows of ``df``.

    Rows are brought together by partition before the write so that each has few
    files; ``tasks_per_partition`` deals a large partition out over several.
    """
    if tasks_per_partition and tasks_per_partition > 1:
        deal = F.pmod(F.xxhash64(*df.columns), F.lit(tasks_per_partition))
        placed = df.repartition(*partitions, deal)
    else:
        # AQE splits a partition that is too large and joins ones that are small
        placed = df.hint("rebalance", *partitions)
    (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).parquet(path))
    return measured(df, measures) if measures else {}


def write_version(df: DataFrame, root: str, partitions: list[str] | None = None) -> str:
    """Write ``df`` to a fresh folder below ``root``; what its plan reads stays as it is."""
    path = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return path


def point_at(spark: SparkSession, table: str, path: str, partitions: list[str] | None = None) -> None:
    """Let ``table`` read the version at ``path``."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    if partitions:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def point_partition(spark: SparkSession, table: str, partition: dict[str, str], path: str) -> None:
    """Let one partition of ``table`` read the files at ``path``."""
    spec = ", ".join(f"`{c}` = '{v}'" for c, v in partition.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")
    spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def merge_partitions(
    target: DataFrame, batch: DataFrame, keys: list[str], merge: Callable[[DataFrame], DataFrame], path: str, partition: str,
    measures: dict[str, Column] | None = None,
) -> dict:
    """Rewrite only the partitions the batch touches: its own and those that hold its keys.

    ``merge`` takes the target rows of those partitions, null being one of them; their names (one
    per folder) go through the driver so that the scan lists no other folder. The result
    is written aside first, because it reads the files that are about to be replaced.
    A partition all of whose rows moved to others is removed, before the others are written: if the
    load stops in between, its rows are in the batch that is loaded again.
    Returns ``measures`` (by default ``rows``) of the rewritten partitions.
    """
    held = target.select(*keys, partition).join(batch.select(*keys), keys, "left_semi").select(partition)
    touched = [r[0] for r in batch.select(partition).unionByName(held).distinct().collect()]
    of_these = F.col(partition).isin([v for v in touched if v is not None])
    rows = target.where(of_these | F.col(partition).isNull() if None in touched else of_these)
    merged, seen = materialize_measured(merge(rows), "merged", measures)
    left = {r[0] for r in merged.select(partition).distinct().collect()}
    for value in set(touched) - left:
        remove(target.sparkSession, f"{path}/{partition}={NULL_PARTITION if value is None else value}")
    overwrite_partitions(merged, path, [partition])
    return seen


def append_partitioned(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Add rows to a table on files."""
    df.write.mode("append").partitionBy(*partitions).parquet(path)


def append_log(spark: SparkSession, entries: list[dict] | DataFrame, path: str) -> None:
    """Append DQ log rows, one folder per source asset, in one write.

    ``entries`` are a few rows as dictionaries, whose values are bound and not spliced
    into SQL, or a frame with some of the log's columns; the others are null.
    """
    if isinstance(entries, DataFrame):
        held = {f.name: F.col(f.name) if f.name in entries.columns else F.lit(None) for f in DQ_LOG_SCHEMA}
        rows = entries.select(*[held[f.name].cast(f.dataType).alias(f.name) for f in DQ_LOG_SCHEMA])
    else:
        rows = spark.createDataFrame([tuple(e.get(c) for c in DQ_LOG_SCHEMA.names) for e in entries], DQ_LOG_SCHEMA).coalesce(1)
    append_partitioned(rows, path, ["SourceDataAsset"])


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DQ_LOG_SCHEMA).parquet(path).select(DQ_LOG_SCHEMA.names)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per task."""
    df.write.option("header", True).csv(path)
