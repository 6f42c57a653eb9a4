"""Jaccard join on word shingles: light sets by subsets, heavy sets by inverted lists.

Sets are the distinct runs of five words of a text. Equal sets are one class. The
join of the classes goes as follows.

1. Shingles are dealt out by ranges of their hash, as sorted and packed arrays. A
   shingle of one class alone cannot be shared, and a class with too few shared
   shingles has no partner: both end here, with the number of classes that hold each
   shingle, its frequency.
2. What is left of each class is ordered from the rarest shingle on. Two sets that are
   similar enough share ``k`` of their first ``n - ceil(0.75 n) + k`` shingles.
3. Light sets enumerate all subsets of two of these (k = 2), heavy ones look their first
   shingles up in inverted lists (k = 1). The size that divides them is the one with
   the least estimated cost, subsets enumerated against list entries scanned: a list is
   scanned once, neighbour by neighbour, so each entry has a fixed cost. Light sets
   large enough to be similar to a heavy one are in the lists too.
4. Neighbours in a list are compared first. Sets that are linked then need no further
   comparison with each other, so a large group of near copies never becomes all its
   pairs. Every other pair that shares a key is compared next, unless its sizes, its
   places in the order, or the parity bits of its sets, which differ in at most as many
   places as the sets do, rule the similarity out. Nothing is capped.
5. Links become components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.durable import materialize
from lakeops.llm.components import components
from lakeops.llm.frames import TEXT, bound_batches, free_prefix, lean, map_texts, named
from lakeops.llm.words import SPACED, Block, mix, small_blocks, window_hashes
from lakeops.operators.skew import hashable

WIDTH = 5
#: postings a task sorts at a time, and those of one range of hashes
BLOCK_POSTINGS = 1_500_000
RANGE_POSTINGS = 2_500_000
#: hash bits of a shingle in the index
BITS = 48
#: an entry of an inverted list is written as a subset is, and compared with its neighbour as well
ENTRY_COST = 2.0
#: list entries that one task orders; a longer list is split
LIST_PART = 4096
#: what names a set: 96 bits and its size
#: words of 64 parity bits of a set
PARITY_WORDS = 16
_ID = np.dtype([("hi", "<u8"), ("lo", "<u4"), ("n", "<u4")])


def needed(n):
    """The smallest overlap of a set of ``n`` with one it is linked to: ceil(0.75 n)."""
    return -(-3 * n // 4)


def shingles(block: Block, i: int, width: int = WIDTH) -> np.ndarray:
    """The distinct shingle hashes of one text, sorted; a shorter text is one shingle."""
    words = block.hashes[block.offsets[i]:block.offsets[i + 1]]
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(width, len(words))))


def _identity(s: np.ndarray) -> tuple[int, int]:
    """64 and 32 bits that do not depend on the order."""
    low = int(np.bitwise_xor.reduce(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)))) if len(s) else 0
    return int(s.sum(dtype=np.uint64)), low >> 32


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def set_keys(docs: DataFrame, keep: list[str], text: str, width: int, prefix: str = "") -> DataFrame:
    """The ``keep`` columns with the size of each text's set and 128 bits that name the set."""
    def build():
        def work(texts, rows):
            block = Block(texts, SPACED)
            sets = [shingles(block, i, width) for i in range(len(texts))]
            keys = [_identity(s) for s in sets]
            return [[len(s) for s in sets], [_signed(k[0]) for k in keys], [k[1] for k in keys]]
        return work
    return map_texts(docs, keep, text, "n_shingles long, hi long, lo long", build, prefix)


# --- packed arrays -------------------------------------------------------------------

def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays with their bytes sorted by significance, which compresses the high ones away."""
    parts = []
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b""
        small = zstandard.ZstdCompressor(level=1).compress(raw)
        parts.append(np.array([len(a), len(small)], "<u8").tobytes() + small)
    return b"".join(parts)


def _unpack(data: bytes, *kinds) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        n, size = (int(x) for x in np.frombuffer(data, "<u8", 2, at))
        raw = zstandard.ZstdDecompressor().decompress(data[at + 16:at + 16 + size], max_output_size=max(1, n * np.dtype(kind).itemsize))
        at += 16 + size
        width = np.dtype(kind).itemsize
        out.append(np.frombuffer(np.frombuffer(raw, np.uint8).reshape(width, n).T.tobytes(), kind))
    return out


def _shingle_bytes(h: np.ndarray) -> bytes:
    """48-bit hashes, six bytes each."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BITS // 8]).tobytes()


def _shingle_array(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, BITS // 8)
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :BITS // 8] = six
    return wide.view("<u8").ravel()


# --- step 1: frequencies ---------------------------------------------------------------

def _postings(docs: DataFrame, text: str, width: int, ranges: int) -> DataFrame:
    """Packed postings of each block of documents for each range of hashes."""
    step = -(-(1 << BITS) // ranges)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[tuple[int, int, int], int] = {}
        held: list[np.ndarray] = []
        size = 0

        def flush():
            names = np.array(list(ids), dtype=_ID)
            lengths = names["n"]
            h = np.concatenate(held) >> np.uint64(64 - BITS)
            held.clear()
            order = np.argsort(h).astype(np.uint32)
            h, owner = h[order], np.repeat(np.arange(len(names), dtype=np.uint32), lengths)[order]
            cuts = np.searchsorted(h, np.arange(0, ranges + 1, dtype=np.uint64) * np.uint64(step))
            for r in range(ranges):
                a, b = cuts[r], cuts[r + 1]
                if a < b:
                    own, local = np.unique(owner[a:b], return_inverse=True)
                    gaps = np.diff(h[a:b], prepend=np.uint64(r * step))
                    blob = _pack(names[own], gaps, local.astype(np.uint32))
                    yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([blob], pa.binary())], names=["part", "blob"])

        for _, texts in small_blocks(batches, TEXT):
            block = Block(texts, SPACED)
            for i in range(len(texts)):
                s = shingles(block, i, width)
                key = (*_identity(s), len(s))
                if len(s) and key not in ids:
                    ids[key] = len(ids)
                    held.append(s)
                    size += len(s)
                    if size >= BLOCK_POSTINGS:
                        yield from flush()
                        ids.clear()
                        held.clear()
                        size = 0
        if size:
            yield from flush()

    return bound_batches(docs).select(named(text).cast("string").alias(TEXT)).mapInArrow(run, "part int, blob binary")


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different sets in order, and for each name the number of its set."""
    order = np.lexsort((names["n"], names["lo"], names["hi"]))
    ranked = names[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(names), np.uint32)
    number[order] = np.cumsum(new) - 1
    return ranked[new], number


def _shared(postings: DataFrame, groups: int) -> DataFrame:
    """Postings of the shingles that at least two classes hold, packed by groups of classes."""
    @lean
    def merge(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        step = -(-(1 << BITS) // groups)
        names, hashes, owners, count = [], [], [], 0
        for data in table.column("blob"):
            n, gaps, local = _unpack(data.as_py(), _ID, "<u8", "<u4")
            names.append(n)
            hashes.append(np.cumsum(gaps, dtype=np.uint64))
            owners.append(local + np.uint32(count))
            count += len(n)
        # copies of a set come from several blocks
        classes, number = _distinct(np.concatenate(names))
        names.clear()
        h = np.concatenate(hashes)
        hashes.clear()
        owner = number[np.concatenate(owners)]
        owners.clear()
        # by shingle, and within it by class
        order = np.lexsort((owner, h)).astype(np.uint32)
        h, owner = h[order], owner[order]
        del order
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        single = first.copy()
        single[1:] |= owner[1:] != owner[:-1]
        h, owner, first = h[single], owner[single], first[single]
        begins = np.flatnonzero(first)
        run = np.diff(np.append(begins, len(h)))
        keep = np.repeat(run >= 2, run)
        df = np.repeat(run, run)[keep].astype(np.uint32)
        h, owner = h[keep], owner[keep]
        order = np.argsort(owner, kind="stable")  # classes are in the order of their names
        h, owner, df = h[order], owner[order], df[order]
        own, starts = np.unique(owner, return_index=True)
        lengths = np.diff(np.append(starts, len(owner))).astype(np.uint32)
        groups_of = (classes["hi"][own] >> np.uint64(64 - BITS)) // np.uint64(step)
        out_group, out_blob = [], []
        cuts = np.searchsorted(groups_of, np.arange(groups + 1, dtype=np.uint64))
        ends = np.append(starts, len(owner))
        for g in range(groups):
            a, b = cuts[g], cuts[g + 1]
            if a < b:
                x, y = ends[a], ends[b]
                out_group.append(g)
                out_blob.append(_pack(classes[own[a:b]], lengths[a:b], h[x:y], df[x:y]))
        return pa.table({"grp": pa.array(out_group, pa.int32()), "blob": pa.array(out_blob, pa.binary())})

    return postings.groupBy("part").applyInArrow(merge, "grp int, blob binary")


_SETS = (
    "hi long, lo long, n int, shared int, shingles binary, first binary, first_df array<int>, "
    "subsets double, scans double, size_class int, parity array<long>"
)


def _parity(h: np.ndarray) -> list[int]:
    """Bits that say whether an odd number of the shingles falls on them."""
    odd = np.bincount((mix(h) >> np.uint64(32)).astype(np.int64) % (64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def _candidates(shared: DataFrame) -> DataFrame:
    """The classes with enough shared shingles, with their first ones from the rarest on."""
    @lean
    def gather(table: pa.Table) -> pa.Table:
        names, lengths, hashes, dfs = [], [], [], []
        for data in table.column("blob"):
            n, k, h, df = _unpack(data.as_py(), _ID, "<u4", "<u8", "<u4")
            names.append(n)
            lengths.append(k)
            hashes.append(h)
            dfs.append(df)
        classes, number = _distinct(np.concatenate(names))
        h, df = np.concatenate(hashes), np.concatenate(dfs)
        hashes.clear()
        owner = np.repeat(number, np.concatenate(lengths))
        shared_count = np.bincount(owner, minlength=len(classes))
        good = shared_count >= needed(classes["n"].astype(np.int64))
        keep = good[owner]
        h, df, owner = h[keep], df[keep], owner[keep]
        order = np.lexsort((h, df, owner))
        h, df, owner = h[order], df[order], owner[order]
        ends = np.cumsum(np.where(good, shared_count, 0))
        rows = {f.split()[0]: [] for f in _SETS.split(", ")}
        for c in np.flatnonzero(good):
            b = ends[c]
            a = b - shared_count[c]
            n, held = int(classes["n"][c]), int(shared_count[c])
            # unshared shingles are the rarest and take the first places
            places = max(0, n - int(needed(n)) + 1 - (n - held))
            first = min(held, places + 1)
            rows["hi"].append(_signed(int(classes["hi"][c])))
            rows["lo"].append(int(classes["lo"][c]))
            rows["n"].append(n)
            rows["shared"].append(held)
            rows["shingles"].append(_shingle_bytes(np.sort(h[a:b])))
            rows["first"].append(_shingle_bytes(h[a:a + first]))
            rows["first_df"].append(df[a:a + first].tolist())
            rows["subsets"].append(first * (first - 1) / 2)
            rows["scans"].append(ENTRY_COST * places)
            rows["size_class"].append(int(math.log(n) / math.log(1.1)))
            rows["parity"].append(_parity(h[a:b]))
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
        return pa.table({f.split()[0]: pa.array(rows[f.split()[0]], kinds[f.split()[1]]) for f in _SETS.split(", ")})

    return shared.groupBy("grp").applyInArrow(gather, _SETS)


# --- steps 2 and 3: keys ---------------------------------------------------------------

def boundary(sets: DataFrame) -> int:
    """The largest size that is light: the one with the least total of subsets and scans.

    One row for each size class, of which a factor of 1.1 in size makes one.
    """
    costs = sets.groupBy("size_class").agg(
        F.max("n").alias("n"), F.sum("subsets").alias("subsets"), F.sum("scans").alias("scans"),
    ).orderBy("size_class").collect()
    best, light, heavy = (sum(r["scans"] for r in costs), 0), 0.0, sum(r["scans"] for r in costs)
    for r in costs:
        light, heavy = light + r["subsets"], heavy - r["scans"]
        best = min(best, (light + heavy, r["n"]))
    return best[1]


_KEYS = "key long, parts int, part int, node long, n int, place int"


def _keys(sets: DataFrame, limit: int) -> DataFrame:
    """A row for each key of each set: subsets of two for light sets, first shingles for heavy ones.

    ``place`` counts the set's shingles that come before the key's last one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                h, df = _shingle_array(row["first"]), np.array(row["first_df"], np.int64)
                n, unshared = row["n"], row["n"] - row["shared"]
                light = n <= limit
                made = []
                if light and len(h) > 1:
                    i, j = np.triu_indices(len(h), 1)
                    key = mix(mix(np.minimum(h[i], h[j])) + np.maximum(h[i], h[j]))
                    made.append((key, np.minimum(df[i], df[j]), unshared + j))
                # similar to a heavy one, which has limit + 1 shingles at least
                if n >= needed(limit + 1):
                    places = max(0, n - int(needed(n)) + 1 - unshared)
                    made.append((mix(h[:places] + np.uint64(1)), df[:places], unshared + np.arange(places)))
                for key, often, place in made:
                    m = len(key)
                    parts = -(-often // LIST_PART)
                    part = mix(key ^ np.uint64(row["node"])) % parts.astype(np.uint64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.view(np.int64)), pa.array(parts.astype(np.int32)), pa.array(part.astype(np.int32)),
                        pa.array(np.full(m, row["node"], np.int64)), pa.array(np.full(m, n, np.int32)), pa.array(place.astype(np.int32)),
                    ], names=["key", "parts", "part", "node", "n", "place"])

    return sets.select("node", "n", "shared", "first", "first_df").mapInArrow(_whole(run), _KEYS)


def _whole(run):
    """The batches of ``run`` in pieces of many rows."""
    @lean
    def gathered(batches):
        held, size = [], 0
        for b in run(batches):
            held.append(b)
            size += len(b)
            if size > 50_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return gathered


def _possible(n1: str, place1: str, n2: str, place2: str):
    """Whether sizes, and what can still be shared from the places of a common key on, allow a link."""
    a, b = F.col(n1), F.col(n2)
    # overlap >= 3/7 of the sum of the sizes is the same as similarity >= 0.75
    most = F.least(a - F.col(place1), b - F.col(place2)) + F.least(F.col(place1), F.col(place2))
    return (4 * F.least(a, b) >= 3 * F.greatest(a, b)) & (7 * most >= 3 * (a + b))


def _neighbours(keys: DataFrame) -> DataFrame:
    """Pairs of sets that follow each other under a key, by size; parts of a long list are chained."""
    order = [F.col("n"), F.xxhash64("key", "node")]
    here = Window.partitionBy("key", "part").orderBy(*order)
    pairs = keys.withColumn("n2", F.lag("n").over(here)).withColumn("node2", F.lag("node").over(here))
    heads = keys.where("parts > 1").groupBy("key", "part").agg(F.min(F.struct("n", "node")).alias("h")).select("key", "part", "h.*")
    chain = Window.partitionBy("key").orderBy("part")
    chained = heads.withColumn("n2", F.lag("n").over(chain)).withColumn("node2", F.lag("node").over(chain))
    columns = ["node", "n", "node2", "n2"]
    both = pairs.select(*columns).unionByName(chained.select(*columns)).where("node2 IS NOT NULL")
    return _pairs(both.where(4 * F.least("n", "n2") >= 3 * F.greatest("n", "n2")))


def _pairs(found: DataFrame) -> DataFrame:
    return found.where("node <> node2").select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


# --- step 4: comparison ------------------------------------------------------------------

def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs whose sets are similar, by their whole shingle sets."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))

    @lean
    def run(batches):
        for batch in batches:
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            keep, last, a = np.zeros(len(batch), bool), None, None
            s_a, s_b = batch.column("s_a"), batch.column("s_b")
            for i in range(len(batch)):
                x = s_a[i].as_py()
                if x != last:
                    last, a = x, _shingle_array(x)
                b = _shingle_array(s_b[i].as_py())
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                overlap = int((a[at] == b).sum())
                keep[i] = 100 * overlap >= 75 * (int(n_a[i]) + int(n_b[i]) - overlap)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    return pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _rest(keys: DataFrame, roots: DataFrame, compared: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs under a common key that are not connected yet, not compared and not ruled out.

    Linked sets of sizes a and b differ in (a + b) / 7 shingles at most, so one of them at least has no
    more than a seventh of its own that are in no other set. Only such sets are joined with the others of their
    key: documents that share a passage and have more than that of their own never meet.
    """
    placed = keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    bits = [F.col("parity")[i].alias(f"p{i}") for i in range(PARITY_WORDS)]
    own = sets.select("node", (F.col("n") - F.col("shared")).alias("unshared"), *bits)
    placed = materialize(
        placed.join(open_keys, "key", "left_semi").select("key", "node", "n", "place", "root").join(own, "node"), "placed"
    )
    other = placed.toDF(*[c if c == "key" else f"{c}_2" for c in placed.columns])
    # shingles of one set alone are in the difference, and so is one at least for each bit that differs
    differ = F.col("unshared") + F.col("unshared_2")
    for i in range(PARITY_WORDS):
        differ = differ + F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"p{i}_2")))
    close = placed.where("7 * unshared <= n")
    once = (F.col("node") < F.col("node_2")) | (7 * F.col("unshared_2") > F.col("n_2"))
    met = close.join(other, "key").where(
        (F.col("node") != F.col("node_2")) & once & (F.col("root") != F.col("root_2")) & _possible("n", "place", "n_2", "place_2")
        & (7 * differ <= F.col("n") + F.col("n_2"))
    )
    return _pairs(met.select("node", F.col("node_2").alias("node2"))).join(compared, ["a", "b"], "left_anti")


def classes_of(docs: DataFrame, text: str, doc_id: str, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """The rows' sets, and for each non-empty set that occurs its ``smallest`` id and its group.

    The first frame has a row for each row of ``docs``: ``id``, ``n_shingles``, ``hi`` and
    ``lo``, which name the set. The second has ``hi``, ``lo``, ``n_shingles``, ``smallest``,
    the ``component_id`` (the smallest id of the group, nulls aside) and ``chosen``, true
    for one set of each group: the one that holds the smallest id.
    """
    source = docs.select(named(doc_id).cast("long").alias("id"), named(text).cast("string").alias("body"))
    rows = materialize(set_keys(source, ["id"], "body", width), "sets")
    name = ["hi", "lo", "n_shingles"]
    classes = materialize(rows.where("n_shingles > 0").groupBy(*name).agg(F.min("id").alias("smallest")), "classes")
    total = classes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first()["n"]
    ranges = max(1, -(-total // RANGE_POSTINGS))
    sets = materialize(
        _candidates(_shared(_postings(source, "body", width, ranges), ranges)).withColumn("node", F.monotonically_increasing_id()),
        "candidates",
    )
    keys = materialize(_keys(sets, boundary(sets)), "keys")
    first = materialize(_neighbours(keys), "neighbours")
    links = materialize(_linked(first, sets), "links")
    roots = components(links)
    more = materialize(_rest(keys, roots, first, sets), "others")
    links = materialize(_linked(more, sets), "links")
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))
    # all but the sets that are linked with another are groups of their own
    both = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    linked = sets.select("hi", "lo", F.col("n").cast("long").alias("n_shingles"), "node").join(both, "node")
    placed = linked.select(*name, "root").join(classes, name)
    # an id that is null comes last
    best = F.min(F.struct(F.col("smallest").isNull(), "smallest", *name)).alias("best")
    lowest = placed.groupBy("root").agg(best).select("root", F.col("best.smallest").alias("component_id"), *[F.col(f"best.{c}").alias(f"best_{c}") for c in name])
    same = (F.col("hi") == F.col("best_hi")) & (F.col("lo") == F.col("best_lo")) & (F.col("n_shingles") == F.col("best_n_shingles"))
    grouped = materialize(placed.join(lowest, "root").select(*name, "component_id", same.alias("chosen")), "groups")
    alone = F.col("chosen").isNull()
    known = classes.join(grouped, name, "left").select(
        *name, "smallest", F.when(alone, F.col("smallest")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("chosen", F.lit(True)).alias("chosen"),
    )
    return rows, materialize(known, "classes")


def link(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    Words are runs of characters other than white space, A-Z in lower case. A text's set
    holds its distinct shingles of ``width`` words, or, with fewer words, all of them as
    one. Two rows are linked when their sets' similarity is 0.75 or more; the component
    is the smallest ``doc_id`` reachable, null if all of its ids are. Null, empty and
    blank texts have empty sets, are linked with nothing and are their own component.
    Repeated rows are rows of their own.
    """
    rows, known = classes_of(docs, text, doc_id, width)
    out = rows.join(known.select("hi", "lo", "n_shingles", "component_id", "chosen"), ["hi", "lo", "n_shingles"], "left")
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles",
        F.when(F.col("chosen").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` without those that are linked with a kept one.

    Of each component the row with the smallest id stays, of rows that repeat it always the same;
    all rows with an empty set stay. The columns of ``docs`` are kept as they are.
    """
    _, known = classes_of(docs, text, doc_id, width)
    p = free_prefix(docs)
    kept = known.where("chosen").select(*[F.col(c).alias(f"{p}kept_{c}") for c in ("hi", "lo", "n_shingles", "smallest")])
    rows = set_keys(docs, docs.columns, text, width, p)
    is_kept = reduce(lambda x, y: x & y, [F.col(f"{p}{c}") == F.col(f"{p}kept_{c}") for c in ("hi", "lo", "n_shingles")])
    same_id = named(doc_id).cast("long").eqNullSafe(F.col(f"{p}kept_smallest"))
    # rows without a set are no copies of each other
    alone = F.when(F.col(f"{p}n_shingles") == 0, F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("long"))
    found = rows.withColumn(f"{p}alone", alone).join(kept, is_kept & same_id, "left").where(
        F.col(f"{p}kept_hi").isNotNull() | (F.col(f"{p}n_shingles") == 0)
    )
    # of rows that differ in other columns the one with the smallest hash of them all, wherever they lie
    whole = F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    single = found.groupBy(f"{p}hi", f"{p}lo", f"{p}n_shingles", f"{p}alone").agg(
        F.min_by(whole, F.xxhash64(*[named(c) for c in hashable(docs)])).alias("kept")
    )
    return single.select("kept.*").toDF(*docs.columns)
