"""Database tables over JDBC, read in parallel, with a bounded wait for a sleeping server."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def retry_until(read: Callable[[], DataFrame], budget: float = 120.0, pause: float = 10.0,
                clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Call ``read`` until it answers or the budget (seconds) is spent; then raise its last error."""
    ends = clock() + budget
    while True:
        try:
            return read()
        except Exception as error:
            if clock() + pause > ends:
                raise
            log.warning("source does not answer yet: %s", error)
            sleep(pause)


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    options: dict[str, str],
    split_on: tuple[str, int | str, int | str, int] | None = None,
    budget: float = 120.0,
    pause: float = 10.0,
) -> DataFrame:
    """A database table; ``split_on`` = (column, lower, upper, parts) reads it in parts at once."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_on is not None:
        column, lower, upper, parts = split_on
        reader = reader.options(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts)
        )
    return retry_until(reader.load, budget, pause)
