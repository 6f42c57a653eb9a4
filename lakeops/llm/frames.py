"""How the operators of this package read frames and hand rows to numpy."""

from __future__ import annotations

import ctypes
import functools
import gc
import inspect
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.words import BLOCK_BYTES, small_blocks

TEXT = "__text_to_read"
MOST_BYTES = 4 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def named(column: str) -> Column:
    """A top-level column by its whole name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of an id as text, modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands rows to Python a few megabytes at a time.

    Ten thousand rows, the usual batch, of long texts would fill a task. A setting of
    fewer bytes stays.
    """
    conf = df.sparkSession.conf
    held = conf.get(BATCH_BYTES).rstrip("bB")
    if not held.isdigit() or int(held) > MOST_BYTES:
        conf.set(BATCH_BYTES, str(MOST_BYTES))
    return df


def fields(ddl: str) -> list[T.StructField]:
    return T._parse_datatype_string(ddl).fields


def _release() -> None:
    """Give freed memory back to the system: workers live on from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # another C library, which has no such call
    _LIBC = None


def lean(run: Callable) -> Callable:
    """A function from batches to batches, or from a table to a table, that releases memory when it ends."""
    if inspect.isgeneratorfunction(run):
        @functools.wraps(run)
        def batches_to_batches(batches):
            try:
                yield from run(batches)
            finally:
                _release()
        return batches_to_batches

    @functools.wraps(run)
    def table_to_table(table):
        try:
            return run(table)
        finally:
            _release()
    return table_to_table


def map_texts(
    df: DataFrame,
    keep: list[str],
    text: str,
    new: str,
    build: Callable[[], Callable[[list[bytes], pa.RecordBatch], list]],
    prefix: str = "",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``keep`` columns of every row, and the ``new`` columns computed from its whole text.

    ``new`` is a DDL list; ``prefix`` goes before its names. ``build`` runs once in
    each task and returns the function from the UTF-8 texts of some rows (null is
    empty) and their kept columns to one array or list for each new column. A kept
    column that has the name of a new one gives way to it. Rows are never moved, so a
    lost task is computed again from its part of the input.
    """
    added = [T.StructField(prefix + f.name, f.dataType) for f in fields(new)]
    taken = {f.name.lower() for f in added}
    keep = [c for c in keep if c.lower() not in taken]
    source = df.select(*[named(c) for c in keep], named(text).cast("string").alias(TEXT))
    schema = T.StructType([*source.schema.fields[:-1], *added])
    names = [f.name for f in schema]
    types = [_arrow(f.dataType) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = build()
        for rows, texts in small_blocks(batches, TEXT, block_bytes):
            made = [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(work(texts, rows), types)]
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *made], names=names)

    return map_batches(source, run, schema)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for any column names, also with dots in them."""
    names, made = bound_batches(df).columns, [f.name for f in schema]
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])

    @lean
    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=plain.names)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, plain).toDF(*made)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind])
    return {
        "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
        "boolean": pa.bool_(), "binary": pa.binary(), "smallint": pa.int16(),
    }[kind.simpleString()]


def free_prefix(df: DataFrame, base: str = "__") -> str:
    """A prefix that no column of ``df`` begins with."""
    while any(c.lower().startswith(base) for c in df.columns):
        base += "_"
    return base


def as_text(data: bytes) -> str:
    """Bytes that are not UTF-8 read as U+FFFD."""
    return data.decode("utf-8", "replace")
