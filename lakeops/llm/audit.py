"""How filters interact: what each removes, alone and after others, in every order.

Documents become bit masks of the filters they fail, masks are counted, and the counts of a
mask are added to every step of every order it takes part in. So nothing but counts of at
most 32 masks for each part goes through the 120 orders.

Identical texts are found in two steps. A counting Bloom filter over hashes of the texts is
counted in the tasks, two bits' worth a cell (none, one, more), merged segment by segment
and kept as files in the shared folder. A text with a cell that was counted once is the only
one of its kind. Only the other texts are shuffled, whole, for the smallest id of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.durable import fresh_path
from lakeops.llm.frames import lean, named
from lakeops.llm.store import Store
from lakeops.llm.words import mix

#: cells for each text, cells a text counts in, and cells of one segment
CELLS_PER_TEXT = 16
MARKS = 4
SEGMENT_CELLS = 1 << 22
#: all cells of a text lie in one block of so many, 64 bytes of a segment's file
BLOCK_CELLS = 512
#: hashes a task counts before it hands its counts on
TASK_TEXTS = 1_000_000


# --- the counting filter ------------------------------------------------------------------

@dataclass(frozen=True)
class Sketch:
    """The merged filter: a file for each segment, a bit for each cell, set where it was counted more than once."""

    store: Store
    segments: int
    cells: int  # of one segment

    def segment_of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(32)) * np.uint64(self.segments) >> np.uint64(32)

    def repeats(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash whether its texts may be several. Reads a cache line a hash."""
        hashes = hashes.view(np.uint64)
        segment = self.segment_of(hashes)
        found = np.zeros(len(hashes), bool)
        order = np.argsort(segment, kind="stable")
        cuts = np.flatnonzero(np.diff(segment[order])) + 1
        for rows in np.split(order, cuts):
            if len(rows):
                bits = self.store.open(f"cells-{segment[rows[0]]}", "u1")
                at = _cells(hashes[rows], self.cells)
                found[rows] = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)
        return found


def _cells(hashes: np.ndarray, of: int) -> np.ndarray:
    """The cells of each hash in its segment, a row each: some of one block."""
    low = mix(hashes)
    block = (low >> np.uint64(40)) % np.uint64(of // BLOCK_CELLS)
    shifts = np.arange(MARKS, dtype=np.uint64) * np.uint64(9)
    inside = low[:, None] >> shifts & np.uint64(BLOCK_CELLS - 1)
    return (block[:, None] * np.uint64(BLOCK_CELLS) + inside).astype(np.int64)


def count_cells(hashes: DataFrame, texts: int, cells: int = SEGMENT_CELLS) -> Sketch:
    """The sketch of a frame with one column of 64-bit hashes, a row for each of about ``texts`` texts.

    A task counts a hash it meets again once more but keeps it once, so a group of copies
    costs what two texts do.
    The number of segments follows ``texts``; no segment's counts are larger than the others'.
    """
    store = Store(fresh_path(hashes.sparkSession, "sketch"))
    sketch = Sketch(store, max(1, -(-texts * CELLS_PER_TEXT // cells)), cells)
    kind = pa.schema([("segment", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())])

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(np.unique(batch.column(0).to_numpy().view(np.uint64), return_counts=True))
            size += len(held[-1][0])
            if size >= TASK_TEXTS:
                yield from _counted(sketch, held, kind)
                held, size = [], 0
        if held:
            yield from _counted(sketch, held, kind)

    @lean
    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(cells, np.uint8)
        for marked, counts in zip(table.column("cells").to_pylist(), table.column("counts").to_pylist()):
            at = np.frombuffer(marked, "<u4")
            total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), 2)
        segment = table.column("segment")[0].as_py()
        sketch.store.write(f"cells-{segment}", np.packbits(total > 1, bitorder="little"))
        return pa.table({"segment": pa.array([segment], pa.int64())})

    counts = hashes.mapInArrow(count, "segment long, cells binary, counts binary")
    counts.groupBy("segment").applyInArrow(merge, "segment long").write.format("noop").mode("overwrite").save()
    return sketch


def _counted(sketch: Sketch, held: list[tuple[np.ndarray, np.ndarray]], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The counts, up to two, of each segment's cells."""
    hashes, place = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
    copies = np.minimum(np.bincount(place, weights=np.concatenate([n for _, n in held])), 2).astype(np.uint8)
    segment = sketch.segment_of(hashes)  # hashes are sorted, so segments are
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(segment)) + 1, [len(hashes)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        marks = np.sort(_cells(hashes[a:b], sketch.cells), axis=1)
        # a text counts once in a cell, however many of its marks fall there
        own = np.concatenate([np.ones((b - a, 1), bool), marks[:, 1:] != marks[:, :-1]], axis=1)
        at, where = np.unique(marks[own], return_inverse=True)
        n = np.bincount(where, weights=np.repeat(copies[a:b], MARKS).reshape(-1, MARKS)[own])
        yield pa.RecordBatch.from_arrays([
            pa.array([int(segment[a])], pa.int64()), pa.array([at.astype("<u4").tobytes()], pa.binary()),
            pa.array([np.minimum(n, 2).astype(np.uint8).tobytes()], pa.binary()),
        ], schema=kind)


def later_copies(docs: DataFrame, doc_id: str, text: Column, keep: dict[str, Column], masked: Column) -> DataFrame:
    """Rows counted by ``id``, the ``keep`` values, ``mask`` and ``later``: whether a smaller id has the same text.

    ``text``, ``masked`` and ``keep`` are expressions over ``docs``, which is read three times. Rows
    of one id are not later than each other; rows without an id come neither before nor after any other.
    Whether a text is later than another rests on the whole texts; a hash only tells the texts of one id apart.
    """
    rows = docs.select(named(doc_id).alias("id"), text.alias("text"), *[c.alias(n) for n, c in keep.items()], masked.alias("mask"))
    hashes = rows.where("id IS NOT NULL").select(F.xxhash64("text").alias("hash"))
    sketch = count_cells(hashes, docs.count())

    @F.pandas_udf("boolean")
    def may_repeat(column: pd.Series) -> pd.Series:
        return pd.Series(sketch.repeats(column.to_numpy()))

    hashed = rows.withColumn("hash", F.xxhash64("text"))
    marked = hashed.withColumn("repeats", may_repeat("hash") & F.col("id").isNotNull())
    counted = marked.groupBy("id", "hash", "repeats", "mask", *keep).agg(F.count(F.lit(1)).alias("n"))
    # whole texts are compared, of possible repeats alone; copies in one task travel once
    suspects = hashed.select("id", "text", "hash").where("id IS NOT NULL").where(may_repeat("hash"))
    first = suspects.groupBy("text").agg(F.min("id").alias("id")).select("id", F.xxhash64("text").alias("hash"), F.lit(True).alias("first"))
    return counted.join(first, ["id", "hash"], "left").select(
        "id", *keep, "mask", (F.col("repeats") & F.col("first").isNull()).alias("later"), "n",
    )


# --- masks and orders ---------------------------------------------------------------------

def mask_counts(rows: DataFrame, labels: DataFrame, doc_id: str, marks: list[str], part: str = "part") -> DataFrame:
    """``part``, ``mask``, ``n`` and for each of ``marks`` how many of the rows a label marks with 1.

    ``rows`` has id, part, mask and n; an id is marked if any of its label rows says so.
    Rows are counted by id before they meet their labels, so an id of many rows, or none, is a few rows.
    """
    said = labels.where(named(doc_id).isNotNull()).groupBy(named(doc_id).alias("id")).agg(
        *[F.max(F.when(named(m) == 1, 1).otherwise(0)).alias(m) for m in marks]
    )
    by_id = rows.groupBy("id", part, "mask").agg(F.sum("n").alias("n"))
    return by_id.join(said, "id", "left").groupBy(part, "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.coalesce(m, F.lit(0)) * F.col("n")).alias(m) for m in marks],
    )


def order_table(masks: DataFrame, filters: str, marks: list[str], part: str = "part") -> DataFrame:
    """Each part's counts for each order of the ``filters`` (a letter each) and each step.

    ``masks`` has the part, ``mask`` (bit i is set if the i-th filter fails), ``n`` and the
    ``marks``. Columns: part, filter_order, step, kept, removed, redundant, unique_fails, for each mark
    ``<mark>_lost``, and shapley. A mask adds to each pair of a filter and the set of filters before it,
    and these sums go to the orders in which they occur, so what is joined does not grow with the rows.
    """
    spark, bits = masks.sparkSession, {f: 1 << i for i, f in enumerate(filters)}
    states = sorted({(sum(bits[g] for g in order[:i]), bits[f]) for order in permutations(filters) for i, f in enumerate(order)})
    orders = ["".join(o) for o in permutations(filters)]
    steps = spark.createDataFrame(
        [(o, i + 1, sum(bits[g] for g in o[:i]), bits[f]) for o in orders for i, f in enumerate(o)],
        "filter_order string, step int, before int, own int",
    )
    n, mask = F.col("n"), F.col("mask")
    held = masks.withColumn("state", F.explode(F.array(*[
        F.struct(F.lit(b).cast("int").alias("before"), F.lit(o).cast("int").alias("own")) for b, o in states
    ]))).select("*", "state.before", "state.own")
    fails, earlier = mask.bitwiseAND(F.col("own")) != 0, mask.bitwiseAND(F.col("before")) != 0
    removed = fails & ~earlier
    total = lambda when, what: F.sum(F.when(when, what).otherwise(0)).cast("long")
    # of a filter that fails with m - 1 others, one order in m has it first
    share = F.expr(f"CAST({len(orders)} AS BIGINT) * n div bit_count(mask)")
    sums = held.groupBy(part, "before", "own").agg(
        total(~fails & ~earlier, n).alias("kept"), total(removed, n).alias("removed"), total(fails & earlier, n).alias("redundant"),
        total(mask == F.col("own"), n).alias("unique_fails"),
        *[total(removed, F.col(m)).alias(f"{m}_lost") for m in marks],
        total(fails, share).alias("shapley"),
    )
    # as many rows as orders have steps
    return sums.join(F.broadcast(steps), ["before", "own"]).drop("before", "own")
