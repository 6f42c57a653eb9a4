"""Serving tables in a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame


def replace_table(
    df: DataFrame, url: str, table: str, options: dict[str, str],
    column_types: dict[str, str] | None = None, connections: int = 8,
) -> None:
    """Replace the rows of a database table from every executor.

    The table keeps its definition (it is emptied, not dropped). On the first load
    it is created with ``column_types``. ``connections`` bounds the parallel writes.
    """
    writer = df.write.format("jdbc").options(
        url=url, dbtable=table, truncate="true", numPartitions=str(connections), **options
    )
    if column_types:
        types = ", ".join(f"{c} {t}" for c, t in column_types.items())
        writer = writer.option("createTableColumnTypes", types)
    writer.mode("overwrite").save()
