"""Conformed tables to a serving database, one to one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.sinks.jdbc import replace_table


def conformed_rows(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def serve_tables(
    spark: SparkSession, tables: dict[str, str], url: str, options: dict[str, str],
    column_types: dict[str, dict[str, str]] | None = None,
) -> None:
    """Replace each database table from its conformed table (``{conformed: served}``)."""
    for conformed, served in tables.items():
        replace_table(conformed_rows(spark, conformed), url, served, options, (column_types or {}).get(conformed))
