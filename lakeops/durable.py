"""Intermediate results that outlive a lost executor.

Results used by several later jobs are written once, as parquet, to the shared
folder named by ``spark.checkpoint.dir``. A session that names none is refused.
Copies stay until ``passing_stages`` ends or the folder is cleared between runs.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_stages: ContextVar[list[str] | None] = ContextVar("stages", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and go on from the written copy."""
    path = fresh_path(df.sparkSession, name)
    made = _stages.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(written: DataFrame, measures: dict[str, Column] | None = None) -> dict:
    """What ``measures`` (aggregates; by default ``rows``) come to in rows that have been written.

    Reads only the columns they need. ``DataFrame.observe`` would save the scan, but a session that has
    observed anything can no longer use models that hold on to it, as a support vector machine does.
    """
    measures = measures or {"rows": F.count(F.lit(1))}
    return written.agg(*[c.alias(name) for name, c in measures.items()]).first().asDict()


def materialize_measured(df: DataFrame, name: str, measures: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
    """``materialize``, and what ``measures`` came to in the rows written."""
    written = materialize(df, name)
    return written, measured(written, measures)


@contextmanager
def passing_stages(spark: SparkSession):
    """Remove the copies made inside once the block is left.

    For loads that hand back no frame; each thread has its own list.
    """
    token = _stages.set([])
    try:
        yield
    finally:
        made = _stages.get()
        _stages.reset(token)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of written rows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
