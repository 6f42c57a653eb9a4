"""Exact k nearest neighbours by tiles, with tiles skipped that cannot matter.

Vectors are turned so that the first components tell most of their spread (principal axes
of a bounded sample; any rotation keeps distances). Chunks of rows along the first axis meet
chunks of queries on a grid, so a vector is copied once per chunk on the other side and not
once per cell. In a chunk, rows and queries are cut into tiles of near vectors. Two boxes, one
around a tile's first components and one around the lengths of what remains, give a lower bound for
all pairs of two tiles: the squared gap between the boxes in the first components plus that
between the remaining lengths. A tile whose bound exceeds what a tile of queries has already found is
skipped; so is a whole chunk, before it is sent.

On vectors without structure no tile can be skipped by any such bound, and the search is the
plain tiled product.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.durable import materialize

#: vectors of a chunk, of a tile, components that bounds are made of, and vectors the axes are taken from
BLOCK_ROWS = 8_192
TILE_ROWS = 128
PREFIX = 8
SAMPLED_ROWS = 4_096
# distances by the product form are compared with this much room for rounding
_ROOM = 1e-9
# candidates kept beyond k before distances are taken term by term
_SPARE = 8


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _lengths(a: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, a)


def _principal(a: np.ndarray) -> np.ndarray:
    """The axes of ``a``, the one of the widest spread first."""
    if len(a) < 2:
        return np.eye(a.shape[1])
    _, axes = np.linalg.eigh(np.cov(a.T).reshape(a.shape[1], -1))
    return np.ascontiguousarray(axes[:, ::-1])


# --- bounds -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Boxes:
    """For each tile (or chunk) the least and largest of its first components and of the remaining length."""

    low: np.ndarray
    high: np.ndarray

    @classmethod
    def around(cls, turned: np.ndarray, begins: np.ndarray) -> Boxes:
        """Of the runs of rows that start at ``begins``."""
        p = min(PREFIX, turned.shape[1])
        rest = np.sqrt((turned[:, p:] ** 2).sum(axis=1))
        at = np.concatenate([turned[:, :p], rest[:, None]], axis=1)
        return cls(np.minimum.reduceat(at, begins), np.maximum.reduceat(at, begins))

    def apart(self, other: Boxes) -> np.ndarray:
        """A lower bound of the squared distance for each pair of a box and a box of ``other``."""
        total = np.zeros((len(self.low), len(other.low)))
        for c in range(self.low.shape[1]):
            gap = np.maximum(self.low[:, c, None] - other.high[None, :, c], other.low[None, :, c] - self.high[:, c, None])
            total += np.maximum(gap, 0) ** 2
        return total


def _tiled(turned: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of rows in which each run of ``tile`` rows is near, and where the runs begin.

    Rows are halved at the median of the component in which they spread most, until they fit.
    """
    p, parts, done = min(PREFIX, turned.shape[1]), [np.arange(len(turned))], []
    while parts:
        rows = parts.pop()
        if len(rows) <= tile:
            done.append(rows)
            continue
        held = turned[rows, :p]
        widest = int(np.argmax(held.max(axis=0) - held.min(axis=0)))
        half = tile * ceil(ceil(len(rows) / tile) / 2)
        order = np.argpartition(held[:, widest], half)
        parts += [rows[order[half:]], rows[order[:half]]]
    return np.concatenate(done), np.cumsum([0, *map(len, done[:-1])])


def search(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int,
           known: np.ndarray, skip_self: bool, tile: int = TILE_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """The places of queries and of their ``k`` best rows, squared distances, and the share of tiles skipped.

    ``known`` is a distance within which each query already has k others (infinite if none). Distances
    are taken term by term from the vectors as they came; ties go to the smaller id.
    """
    axes = _principal(rows)
    turned_q, turned_r = queries @ axes, rows @ axes
    length_q, length_r = _lengths(queries), _lengths(rows)
    (of_q, begin_q), (of_r, begin_r) = _tiled(turned_q, tile), _tiled(turned_r, tile)
    bounds = Boxes.around(turned_q[of_q], begin_q).apart(Boxes.around(turned_r[of_r], begin_r))
    end_r = np.append(begin_r[1:], len(of_r))
    found_q, found_r, found_d, skipped = [], [], [], 0
    for t, first in enumerate(begin_q):
        mine = of_q[first:begin_q[t + 1] if t + 1 < len(begin_q) else len(of_q)]
        order = np.argsort(bounds[t], kind="stable")
        near, at, within, done, step = [], [], known[mine], 0, 1
        while done < len(order):
            # tiles in the order of their bounds, more at a time as the search goes on
            take = order[done:done + step]
            take = take[bounds[t][take] <= within.max() * (1 + _ROOM) + _ROOM]
            if not len(take):
                break
            places = np.concatenate([of_r[begin_r[i]:end_r[i]] for i in take])
            part = np.maximum(length_q[mine, None] + length_r[None, places] - 2 * queries[mine] @ rows[places].T, 0)
            if skip_self:
                part[query_ids[mine][:, None] == ids[places][None, :]] = np.inf
            near.append(part)
            at.append(places)
            done += len(take)
            step *= 2
            if done < len(order):
                joined = np.concatenate(near, axis=1)
                if joined.shape[1] > k:
                    within = np.minimum(within, np.partition(joined, k - 1, axis=1)[:, k - 1])
                near, at = [joined], [np.concatenate(at)]
        skipped += len(order) - done
        if near:
            q, r, d = _best(queries[mine], rows, ids, np.concatenate(near, axis=1), np.concatenate(at), k)
            found_q.append(mine[q])
            found_r.append(r)
            found_d.append(d)
    joined = [np.concatenate(x) if x else np.empty(0, kind) for x, kind in ((found_q, int), (found_r, int), (found_d, float))]
    return (*joined, skipped / bounds.size)


def _best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, near: np.ndarray, places: np.ndarray, k: int):
    """The ``k`` best of each query among ``places``, by distances taken term by term."""
    m = min(k + _SPARE, near.shape[1])
    some = np.argpartition(near, m - 1, axis=1)[:, :m] if m < near.shape[1] else np.tile(np.arange(m), (len(near), 1))
    held = np.take_along_axis(near, some, axis=1)
    limit = np.partition(held, min(k, m) - 1, axis=1)[:, min(k, m) - 1] * (1 + _ROOM) + _ROOM
    # where more rows than were kept lie within the limit, as with many copies, all of them are looked at
    many = np.flatnonzero((near <= limit[:, None]).sum(axis=1) > m)
    few = np.setdiff1d(np.arange(len(near)), many)
    q = [np.repeat(few, m)]
    c = [some[few].ravel()]
    for i in many:
        more = np.flatnonzero(near[i] <= limit[i])
        q.append(np.full(len(more), i))
        c.append(more)
    q, c = np.concatenate(q), np.concatenate(c)
    finite = np.isfinite(near[q, c])
    q, r = q[finite], places[c[finite]]
    exact = np.concatenate([((queries[q[a:a + 65536]] - rows[r[a:a + 65536]]) ** 2).sum(axis=1) for a in range(0, len(q), 65536)] or [np.empty(0)])
    order = np.lexsort((ids[r], exact, q))
    q, r, exact = q[order], r[order], exact[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(q, minlength=len(queries)))[:-1]]).astype(int)
    best = np.arange(len(q)) - first[q] < k
    return q[best], r[best], exact[best]


# --- frames -------------------------------------------------------------------------------

def _axes(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Principal axes of at most ``SAMPLED_ROWS`` or so rows, and those rows along the first of them."""
    buckets = 1 << 30
    share = F.pmod(F.xxhash64("v"), F.lit(buckets)) < ceil(buckets * min(1.0, SAMPLED_ROWS / n))
    held = _matrix(rows.where(share).select("v").limit(2 * SAMPLED_ROWS).toArrow().column("v"))
    axes = _principal(held)
    return axes, np.sort(held @ axes[:, 0])


def _placed(df: DataFrame, axis: np.ndarray, edges: np.ndarray) -> DataFrame:
    """``df`` of ``id, v, label`` with its ``place`` along the first axis."""
    def place(batches):
        for batch in batches:
            at = np.searchsorted(edges, _matrix(batch.column("v")) @ axis, "right") if len(batch) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], names=["id", "v", "label", "place"])
    return materialize(df.mapInArrow(place, "id bigint, v array<double>, label string, place int"), "placed")


def _chunked(placed: DataFrame, block_rows: int) -> tuple[DataFrame, list[int]]:
    """``placed`` with the number of its ``chunk``, and the place of each chunk.

    A place that holds far more rows than meant, as of many copies, is dealt out by id.
    """
    counts = placed.groupBy("place").agg(F.count(F.lit(1)).alias("n")).orderBy("place").collect()  # a row a place
    parts = [max(1, ceil(c["n"] / (2 * block_rows))) for c in counts]
    first = np.concatenate([[0], np.cumsum(parts)]).astype(int).tolist()
    table = placed.sparkSession.createDataFrame([(c["place"], f, p) for c, f, p in zip(counts, first, parts)], "place int, first int, parts int")
    # as many rows as places
    chunked = placed.join(F.broadcast(table), "place").select(
        "id", "v", "label", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("chunk"),
    )
    return chunked, [c["place"] for c, p in zip(counts, parts) for _ in range(p)]


def _met(queries: DataFrame, rows: DataFrame, pairs: DataFrame, k: int, skip_self: bool) -> DataFrame:
    """The k best rows of each query in each pair of chunks (``q, r``)."""
    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            ids, query_ids = right.column("id").to_numpy(), left.column("id").to_numpy()
            within = left.column("within").to_numpy(zero_copy_only=False)
            q, r, d, _ = search(_matrix(left.column("v")), query_ids, _matrix(right.column("v")), ids, k, within, skip_self)
            labels = right.column("label").combine_chunks().take(pa.array(r))
            return pa.table({"query": query_ids[q], "neighbour": ids[r], "label": labels, "distance": d})
        none = np.empty(0, np.int64)
        return pa.table({"query": none, "neighbour": none, "label": pa.array([], pa.string()), "distance": none.astype(float)})

    left = queries.join(pairs, F.col("chunk") == F.col("q")).select("id", "v", "within", "q", "r")
    right = rows.join(pairs, F.col("chunk") == F.col("r")).select("id", "v", "label", F.col("q").alias("to_q"), F.col("r").alias("of_r"))
    return left.groupBy("q", "r").cogroup(right.groupBy("to_q", "of_r")).applyInArrow(
        best, "query bigint, neighbour bigint, label string, distance double"
    )


def _chunk_boxes(df: DataFrame, axes: np.ndarray) -> list:
    """For each chunk its box (a row a chunk), and the farthest that a row still looks."""
    def boxed(batches):
        for batch in batches:
            if not len(batch):
                continue
            vectors, chunk = _matrix(batch.column("v")), batch.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            begins = np.flatnonzero(np.diff(chunk[order], prepend=-1))
            box = Boxes.around((vectors @ axes)[order], begins)
            within = np.maximum.reduceat(batch.column("within").to_numpy(zero_copy_only=False)[order], begins)
            yield pa.RecordBatch.from_arrays([pa.array(chunk[order][begins]), pa.array(list(box.low)), pa.array(list(box.high)), pa.array(within)],
                                             names=["chunk", "low", "high", "within"])
    held = df.select("v", "chunk", "within").mapInArrow(boxed, "chunk int, low array<double>, high array<double>, within double")
    components = [F.posexplode(F.arrays_zip("low", "high")).alias("c", "x")]
    sides = held.select("chunk", "within", *components).groupBy("chunk", "c").agg(
        F.min("x.low").alias("low"), F.max("x.high").alias("high"), F.max("within").alias("within"))
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("c", c))), lambda s: s[c]).alias(c)
    return sides.groupBy("chunk").agg(in_order("low"), in_order("high"), F.max("within").alias("within")).orderBy("chunk").collect()


def _further(spark, asked: list, held: list, places: tuple[list[int], list[int]]) -> DataFrame:
    """Pairs of chunks (``q, r``) of different places whose boxes are near enough, found in the tasks."""
    boxes = Boxes(np.array([r["low"] for r in held]), np.array([r["high"] for r in held]))
    numbers = np.array([r["chunk"] for r in held], np.int32)
    place_q, place_r = (np.array(x) for x in places)

    def reach(batches):
        for batch in batches:
            if len(batch):
                own = Boxes(_matrix(batch.column("low")), _matrix(batch.column("high")))
                limit = batch.column("within").to_numpy(zero_copy_only=False)[:, None] * (1 + _ROOM) + _ROOM
                chunk = batch.column("chunk").to_numpy()
                i, j = np.nonzero((own.apart(boxes) <= limit) & (place_q[chunk][:, None] != place_r[numbers][None, :]))
                yield pa.RecordBatch.from_arrays([pa.array(chunk[i]), pa.array(numbers[j])], names=["q", "r"])
    rows = spark.createDataFrame([tuple(r) for r in asked], "chunk int, low array<double>, high array<double>, within double")
    return rows.mapInArrow(reach, "q int, r int")


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("distance", "neighbour")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    train: DataFrame, queries: DataFrame, id_column: str, vector: str, label: str, k: int,
    skip_self: bool = False, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query, neighbour, label, distance, rank``: the k nearest training rows by squared distance, exactly.

    Vectors have one length and no nulls inside; rows without a vector take no part. Ties go to the lower id.
    First each chunk of queries meets the training rows of its own place on the first axis, which bounds how
    far its neighbours can be, then the other chunks that its bound does not rule out. A task holds
    a chunk of each side and returns k rows a query.
    Driver: a bounded sample for the axes, and a box for each chunk.
    """
    spark = train.sparkSession
    columns = [F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")]
    rows = train.where(F.col(vector).isNotNull()).select(*columns, F.col(label).cast("string").alias("label"))
    asked = queries.where(F.col(vector).isNotNull()).select(*columns, F.lit(None).cast("string").alias("label"))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query bigint, neighbour bigint, label string, distance double, rank int")
    unbounded, wanted = F.lit(float("inf")).alias("within"), ceil(n / block_rows)
    if wanted == 1:
        queries = asked.count()
        parts = max(1, ceil(queries / (2 * block_rows)))
        asked = asked.select("*", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("chunk"), unbounded)
        pairs = spark.createDataFrame([(q, 0) for q in range(parts)], "q int, r int")
        return _ranked(_met(asked, rows.withColumn("chunk", F.lit(0)), pairs, k, skip_self), k)
    axes, along = _axes(rows, n)
    edges = np.unique(np.quantile(along, np.arange(1, wanted) / wanted))
    rows, place_r = _chunked(_placed(rows, axes[:, 0], edges), block_rows)
    asked, place_q = _chunked(_placed(asked, axes[:, 0], edges), block_rows)
    own = [(q, r) for q, at in enumerate(place_q) for r in range(bisect_left(place_r, at), bisect_right(place_r, at))]
    first = _met(asked.select("*", unbounded), rows, spark.createDataFrame(own, "q int, r int"), k, skip_self)
    first = materialize(_ranked(first, k).drop("rank"), "own")
    # where the own place holds fewer than k, there is no bound yet
    bounds = first.groupBy(F.col("query").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("within"))
    bounded = materialize(asked.join(bounds, "id", "left").withColumn("within", F.coalesce("within", F.lit(float("inf")))), "bounded")
    pairs = _further(spark, _chunk_boxes(bounded, axes), _chunk_boxes(rows.withColumn("within", F.lit(0.0)), axes), (place_q, place_r))
    return _ranked(first.unionByName(_met(bounded, rows, materialize(pairs, "pairs"), k, skip_self)), k)


def vote(neighbours: DataFrame) -> DataFrame:
    """The most frequent label per query; the smallest label among equals."""
    counts = neighbours.groupBy("query", "label").agg(F.count(F.lit(1)).alias("votes"))
    best = F.min_by("label", F.struct(-F.col("votes"), F.col("label")))
    return counts.groupBy("query").agg(best.alias("predicted"), F.max("votes").alias("votes"))
