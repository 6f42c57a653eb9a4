"""Exact top-k by integer inner product, in tiles.

Queries and rows are written to the shared folder as tiles of vectors. A task takes a group of
query tiles, whose size is bounded, and some row tiles, multiplies them tile by tile,
keeps the best k of each query per tile, and merges them. The partial lists of
the tasks meet in a tree: first those of neighbouring partitions, then one list per query.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.durable import fresh_path, materialize
from lakeops.llm.frames import bound_batches, lean, named
from lakeops.llm.store import Store

#: queries that a task holds at a time, a tile in the shared folder, and row tiles a task at least goes through
GROUP_BYTES = 24 << 20
TILE_BYTES = 2 << 20
TILES_A_TASK = 64
TILE_ROWS = 2048
TILE_QUERIES = 256
FAN_IN = 64
#: sums of products below it are exact in doubles
EXACT = float(1 << 53)


def quantised(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double; null where a component is null or not finite."""
    wide = embedding.cast("array<double>")
    # NaN counts as larger than every number, so two comparisons find all that is not finite
    whole = F.forall(wide, lambda x: x.isNotNull() & (x < float("inf")) & (x > float("-inf")))
    return F.when(whole, F.transform(wide, lambda x: F.floor(x * F.lit(float(scale))).cast("double")))


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers, in Python's integers where doubles could round."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    if bound < EXACT:
        return q @ c.T
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)
    return whole(q) @ whole(c).T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the k best columns: rows, ids and scores; columns come in order of their ids."""
    rows, found_ids, found = [], [], []
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)  # the first, so the smallest id, of equal scores
        every = np.arange(len(scores))
        value = scores[every, at].copy()
        rows.append(every)
        found_ids.append(ids[at])
        found.append(value)
        scores[every, at] = -np.inf
    return np.concatenate(rows), np.concatenate(found_ids), np.concatenate(found)


def _matrix(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1])


def _by_length(ids: np.ndarray, vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    lengths = np.array([len(v) for v in vectors])
    out = {}
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        at = at[np.argsort(ids[at], kind="stable")]
        out[int(n)] = ids[at], np.array([vectors[i] for i in at]).reshape(len(at), n)
    return out


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256,
) -> DataFrame:
    """For each row of ``queries`` its ``k`` best rows of ``vectors`` but those with its own id.

    Columns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the integer inner
    product of floor(scale * component). Equal scores rank by the smaller id. Vectors
    that are null, or hold null or non-finite components, and null ids take no part;
    vectors of different lengths are not compared. An id on several rows asks once,
    with its smallest vector, and each such row is a candidate of its own. Scores beyond 64 bits raise an error.
    Both sides are written as tiles to the shared folder; only the tiles' names and sizes reach the driver.
    """
    spark = vectors.sparkSession
    columns = lambda df: df.select(
        named(vec_id).cast("long").alias("id"), quantised(named(embedding), scale).alias("v")
    ).where("id IS NOT NULL AND v IS NOT NULL")
    store = Store(fresh_path(spark, "tiles"))
    asked = _tiles(columns(queries).groupBy("id").agg(F.min("v").alias("v")), store, "query-tiles")
    rows = _tiles(columns(vectors), store, "row-tiles")
    groups = _groups(asked)
    per_length: dict[int, list[int]] = {}
    for g, (n, _) in enumerate(groups):
        per_length.setdefault(n, []).append(g)
    tiles = rows.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    # a task of few tiles where there are few, so that all cores have some, and of TILES_A_TASK beyond that
    buckets = max(1, min(tiles, 2 * spark.sparkContext.defaultParallelism), tiles // TILES_A_TASK)
    meets = F.array()
    for n, of in per_length.items():
        meets = F.when(F.col("n") == n, F.lit(of)).otherwise(meets.cast("array<int>"))
    work = rows.select("tile", "n", "m", F.explode(meets.cast("array<int>")).alias("g"))
    spread = work.repartition(max(1, buckets * len(groups)), "g", F.pmod(F.xxhash64("tile"), F.lit(buckets))).sortWithinPartitions("g")

    @lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, best, ids, q = None, {}, None, None

        def found():
            if best:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([ids[lo + w] for lo, (w, _, _) in best.items()]), pa.int64()),
                    pa.array(np.concatenate([f for _, f, _ in best.values()]), pa.int64()),
                    pa.array([int(s) for _, _, v in best.values() for s in v], pa.int64()),
                ], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for name, n, m, g in zip(*(c.to_pylist() for c in batch.columns)):
                if g != group:
                    yield from found()
                    group, best = g, {}
                    ids, q = (np.concatenate(x) for x in zip(*(_read(store, *t, n) for t in groups[g][1])))
                own_ids, own = _read(store, name, m, n)
                for at in range(0, m, TILE_ROWS):
                    c_ids, c = own_ids[at:at + TILE_ROWS], own[at:at + TILE_ROWS]
                    for lo in range(0, len(q), TILE_QUERIES):
                        scores = _products(q[lo:lo + TILE_QUERIES], c)
                        # a query is no candidate of its own
                        for i in np.flatnonzero(np.isin(ids[lo:lo + TILE_QUERIES], c_ids)):
                            scores[i, c_ids == ids[lo + i]] = -np.inf
                        where, which, value = _best(scores, c_ids, k)
                        keep = (value > -np.inf).astype(bool)
                        best[lo] = _merged(best.get(lo), (where[keep], which[keep], value[keep]), k)
        yield from found()

    partial = spread.mapInArrow(search, "query_id long, vec_id long, score long").withColumn(
        "part", F.floor(F.spark_partition_id() / F.lit(FAN_IN))
    )
    # a negated score can pass 64 bits, so the order is by -(score + 1)
    entry = F.struct((-(F.col("score") + 1)).alias("s"), F.col("vec_id").alias("v"))
    merged = partial.groupBy("query_id", "part").agg(
        F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("top")
    ).groupBy("query_id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    return merged.select("query_id", F.posexplode("top").alias("at", "e")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.col("e.v").alias("vec_id"), (-F.col("e.s") - 1).alias("score"),
    )


def _tiles(df: DataFrame, store: Store, name: str) -> DataFrame:
    """Write ``id, v`` as tiles of vectors of one length, in order of ids; ``tile``, ``n`` its length and ``m`` its vectors.

    An attempt of a task writes under names of its own, and only those of the attempt that counts are listed.
    """
    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def flush(n: int):
            ids, v = (np.concatenate(x) for x in zip(*held.pop(n)))
            order = np.argsort(ids, kind="stable")
            tile = uuid.uuid4().hex
            store.write(tile, np.concatenate([ids[order].view(np.float64), v[order].ravel()]))
            return pa.RecordBatch.from_pydict({
                "tile": pa.array([tile]), "n": pa.array([n], pa.int32()), "m": pa.array([len(ids)], pa.int32()),
            })

        for batch in batches:
            if not len(batch):
                continue
            for n, part in _by_length(batch.column(0).to_numpy(), _matrix(batch.column(1))).items():
                held.setdefault(n, []).append(part)
                if sum(len(ids) for ids, _ in held[n]) * (n + 1) * 8 >= TILE_BYTES:
                    yield flush(n)
        for n in sorted(held):
            yield flush(n)

    return materialize(bound_batches(df).mapInArrow(write, "tile string, n int, m int"), name)


def _read(store: Store, tile: str, m: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    flat = store.open(tile, "f8")
    return flat[:m].view(np.int64), flat[m:].reshape(m, n)


def _groups(tiles: DataFrame) -> list[tuple[int, list[tuple[str, int]]]]:
    """Query tiles of one length that a task holds at a time: the length, and each tile with its vectors."""
    groups, size = [], 0
    for t in tiles.orderBy("n", "tile").collect():
        own = t["m"] * (t["n"] + 1) * 8
        if not groups or groups[-1][0] != t["n"] or size + own > GROUP_BYTES:
            groups.append((t["n"], []))
            size = 0
        groups[-1][1].append((t["tile"], t["m"]))
        size += own
    return groups


def _merged(old, new, k: int):
    """The k best of two lists of (row, id, score), per row."""
    if old is not None:
        new = tuple(np.concatenate(x) for x in zip(old, new))
    where, ids, value = new
    if value.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda i: (where[i], -value[i], ids[i])), dtype=np.int64)
    else:
        order = np.lexsort((ids, -value, where))
    where, ids, value = where[order], ids[order], value[order]
    firsts = np.searchsorted(where, where)
    keep = np.arange(len(where)) - firsts < k
    return where[keep], ids[keep], value[keep]
