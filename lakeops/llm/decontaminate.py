"""Benchmark passages in documents, by Wu-Manber search over words.

The patterns are the windows of consecutive words of the test items. Patterns of
one length share a machine: a table gives, for each block of two words, how far
the search may shift without passing an occurrence; a block that can end a pattern
shifts by nothing, its bucket names the patterns that end so, their first blocks
are compared, and then the words themselves. Documents are cut into lanes that are
searched side by side, each lane over its own window ends, so that most positions
are never looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.durable import fresh_path, materialize
from lakeops.llm.frames import as_text, bound_batches, lean, map_texts, named
from lakeops.llm.store import Store
from lakeops.llm.words import LETTERED, Block

WIDTH = 10
#: bytes of test texts whose machines one task builds, and words of a piece of a long one
CHUNK_BYTES = 8 << 20
PIECE_WORDS = 100_000
LANE = 1024
_BLOCK = np.uint64(0x9FB21C651E98DF25)
_TABLE_BITS = 18


class Machine:
    """Shift table, suffix buckets and patterns of one length."""

    PARTS = {"shift": "i4", "suffix": "u8", "patterns": "u8", "at": "i8"}

    def __init__(self, m: int, shift: np.ndarray, suffix: np.ndarray, patterns: np.ndarray, at: np.ndarray):
        self.m, self.block = m, min(2, m)
        self.shift, self.suffix, self.patterns, self.at = shift, suffix, patterns.reshape(-1, m), at

    @classmethod
    def of(cls, patterns: np.ndarray, at: np.ndarray) -> Machine:
        """``patterns`` has a row of word hashes for each pattern; ``at`` are their numbers."""
        m = patterns.shape[1]
        made = cls(m, np.full(1 << _TABLE_BITS, m - min(2, m) + 1, dtype=np.int32), at, patterns, at)
        for end in range(made.block - 1, m):
            np.minimum.at(made.shift, made._place(made._key(patterns, end)), m - 1 - end)
        last = made._key(patterns, m - 1)
        order = np.argsort(last, kind="stable")
        made.suffix, made.patterns, made.at = last[order], patterns[order], at[order]
        return made

    def _key(self, words: np.ndarray, end: int) -> np.ndarray:
        return words[:, end] if self.block == 1 else words[:, end - 1] * _BLOCK + words[:, end]

    @staticmethod
    def _place(key: np.ndarray) -> np.ndarray:
        return ((key * _BLOCK) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def search(self, words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the occurrences in one document each, and their patterns' numbers, by hash."""
        n = len(words)
        starts = np.arange(self.m - 1, n, LANE)
        ends = np.minimum(starts + LANE, n)
        stops = []
        at = starts
        while len(at):
            key = words[at] if self.block == 1 else words[at - 1] * _BLOCK + words[at]
            step = self.shift[self._place(key)]
            stops.append(at[step == 0])
            at = at + np.maximum(step, 1)
            live = at < ends
            at, ends = at[live], ends[live]
        stop = np.concatenate(stops) if stops else np.empty(0, np.int64)
        stop = stop[owner[stop] == owner[stop - self.m + 1]] if len(stop) else stop
        key = words[stop] if self.block == 1 else words[stop - 1] * _BLOCK + words[stop]
        low, high = np.searchsorted(self.suffix, key, "left"), np.searchsorted(self.suffix, key, "right")
        many = high - low
        stop = np.repeat(stop, many)
        which = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
        for column in range(self.block):  # the first block
            same = words[stop - self.m + 1 + column] == self.patterns[which, column]
            stop, which = stop[same], which[same]
        if len(stop):
            same = (words[stop[:, None] + np.arange(1 - self.m, 1)] == self.patterns[which]).all(axis=1)
            stop, which = stop[same], which[same]
        return stop, self.at[which]


class Patterns:
    """The distinct windows of some items, their words, and the items that hold each, as arrays.

    ``words`` are the bytes of the windows' words one after the other, ``ends`` where each word ends,
    ``firsts`` the first word of each window; ``holders`` are the places of the items that hold the windows,
    ``upto`` where each window's end; ``names`` and ``name_ends`` the items' ids.
    """

    PARTS = {"words": "u1", "ends": "i8", "firsts": "i8", "holders": "i4", "upto": "i8", "names": "u1", "name_ends": "i8"}

    def __init__(self, arrays: dict[str, np.ndarray], machines: list[Machine]):
        self.arrays, self.machines = arrays, machines

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], width: int) -> Patterns:
        block = Block([t for _, t in items], LETTERED)
        numbers: dict[tuple[bytes, ...], int] = {}
        holders: list[dict[int, None]] = []
        hashes: dict[int, list[np.ndarray]] = {}
        at: dict[int, list[int]] = {}
        for i in range(len(items)):
            first, last = block.offsets[i], block.offsets[i + 1]
            m = min(width, last - first)
            if not m:
                continue
            found = [block.data[block.starts[w]:block.ends[w]] for w in range(first, last)]
            for w in range(last - first - m + 1):
                window = tuple(found[w:w + m])
                number = numbers.get(window)
                if number is None:
                    number = numbers[window] = len(holders)
                    holders.append({})
                    hashes.setdefault(int(m), []).append(block.hashes[first + w:first + w + m])
                    at.setdefault(int(m), []).append(number)
                holders[number][i] = None

        def ends(sizes):
            return np.cumsum(np.fromiter(sizes, np.int64), dtype=np.int64)

        def raw(parts):
            return np.frombuffer(b"".join(parts), np.uint8)

        names = [n.encode() for n, _ in items]
        lengths = ends(len(w) for w in numbers)
        arrays = {
            "words": raw(word for w in numbers for word in w), "ends": ends(len(word) for w in numbers for word in w),
            "firsts": np.concatenate([[0], lengths[:-1]]).astype(np.int64) if len(lengths) else lengths,
            "holders": np.fromiter((h for held in holders for h in held), np.int32), "upto": ends(map(len, holders)),
            "names": raw(names), "name_ends": ends(map(len, names)),
        }
        return cls(arrays, [Machine.of(np.array(h), np.array(at[m], dtype=np.int64)) for m, h in sorted(hashes.items())])

    def save(self, store: Store, name: str) -> list[int]:
        """Write all arrays under ``name``; returns the lengths of the patterns."""
        for part in self.PARTS:
            store.write(f"{name}-{part}", self.arrays[part])
        for machine in self.machines:
            for part in Machine.PARTS:
                store.write(f"{name}-{machine.m}-{part}", getattr(machine, part))
        return [machine.m for machine in self.machines]

    @classmethod
    def load(cls, store: Store, name: str, lengths: list[int]) -> Patterns:
        """What ``save`` wrote, mapped and not read."""
        return cls(
            {part: store.open(f"{name}-{part}", kind) for part, kind in cls.PARTS.items()},
            [Machine(m, **{part: store.open(f"{name}-{m}-{part}", kind) for part, kind in Machine.PARTS.items()}) for m in lengths],
        )

    def window(self, number: int, m: int) -> list[bytes]:
        words, ends, first = self.arrays["words"], self.arrays["ends"], self.arrays["firsts"][number]
        bounds = [int(ends[first + k]) if first + k >= 0 else 0 for k in range(-1, m)]
        return [words[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def items_of(self, number: int) -> list[str]:
        holders, upto, names, ends = (self.arrays[part] for part in ("holders", "upto", "names", "name_ends"))
        places = holders[upto[number - 1] if number else 0:upto[number]].tolist()
        return [names[ends[h - 1] if h else 0:ends[h]].tobytes().decode() for h in places]


RESULT = "n_words long, hits array<int>, items array<string>"


def _saved(items: DataFrame, chunks: int, width: int, store: Store) -> list[tuple[str, list[int]]]:
    """The machines of each chunk of test items, built and written by one task each: their name and lengths.

    An attempt of a task writes under a name of its own.
    """
    @lean
    def build(rows: pa.Table) -> pa.Table:
        name = uuid.uuid4().hex
        lengths = Patterns.of([(i, t.encode()) for i, t in zip(rows["id"].to_pylist(), rows["text"].to_pylist())], width).save(store, name)
        return pa.table({"name": [name], "lengths": pa.array([lengths], pa.list_(pa.int32()))})

    chunked = items.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))
    made = chunked.groupBy("chunk").applyInArrow(build, "name string, lengths array<int>").collect()
    return [(r["name"], list(r["lengths"])) for r in made]


def _pieces(items: DataFrame, width: int) -> DataFrame:
    """Distinct items, longer ones cut so that each window of consecutive words lies whole in a piece."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns)):
                block = Block([text.encode()], LETTERED)
                n = len(block.starts)
                step = PIECE_WORDS if n > PIECE_WORDS + width else max(n, 1)
                for first in range(0, max(n - width + 1, min(n, 1)), step):
                    last = min(n, first + step + width - 1)
                    piece = block.data[block.starts[first]:block.ends[last - 1]]
                    yield pa.RecordBatch.from_pydict({"id": [name], "text": [as_text(piece)]})

    distinct = bound_batches(items.distinct())
    return materialize(distinct.mapInArrow(cut, "id string, text string").distinct(), "test-pieces")


def _search(docs: DataFrame, saved: list[tuple[str, list[int]]], store: Store, keep: list[str], text: str, prefix: str) -> DataFrame:
    def build():
        chunks = [Patterns.load(store, *s) for s in saved]

        def work(texts, rows):
            block = Block(texts, LETTERED)
            counts, owner = block.counts, block.owners()
            edge = np.zeros(len(owner) + 1, dtype=np.int32)
            items: list[set[str]] = [set() for _ in texts]
            for p in chunks:
                for machine in p.machines:
                    known: dict[int, tuple[list[bytes], list[str]]] = {}
                    for stop, number in zip(*(x.tolist() for x in machine.search(block.hashes, owner))):
                        if number not in known:
                            known[number] = p.window(number, machine.m), p.items_of(number)
                        words, names = known[number]
                        start = stop - machine.m + 1
                        if all(block.data[block.starts[start + k]:block.ends[start + k]] == w for k, w in enumerate(words)):
                            edge[start] += 1
                            edge[stop + 1] -= 1
                            items[owner[start]].update(names)
            hit = np.cumsum(edge[:-1]) > 0
            runs = []
            for i in range(len(texts)):
                own = hit[block.offsets[i]:block.offsets[i + 1]]
                if not own.any():
                    runs.append([])
                    continue
                change = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                runs.append(change.tolist())
            return [counts, runs, [sorted(s) for s in items]]
        return work

    return map_texts(docs, keep, text, RESULT, build, prefix)


def find_passages(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text",
    item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, prefix: str = "",
) -> DataFrame:
    """The ``keep`` columns with ``n_words``, ``hits`` and ``items`` of each whole text.

    Words are runs of 0-9, A-Z in lower case, and characters beyond ASCII. A window is
    ``width`` consecutive words of a test item, or all words of a shorter one. ``hits``
    holds begin and end of each run of words inside an occurrence, one after the other;
    ``items`` the ids, as strings, of the items with an occurring window, sorted and
    once each. Null and empty texts have no words; items without an id or without words
    are no tests; repeated rows of an item count as one. A task builds the machines of about
    ``CHUNK_BYTES`` of test text and writes them to the shared folder; a long item is cut into pieces
    that overlap. The search maps them, so neither the driver nor a task holds them all.
    """
    items = benchmark.select(
        named(item_id).cast("string").alias("id"), named(item_text).cast("string").alias("text"),
    ).where("id IS NOT NULL AND text IS NOT NULL")
    pieces = _pieces(items, width)
    size = pieces.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    store = Store(fresh_path(docs.sparkSession, "test-windows"))
    taken = {f"{prefix}{c}" for c in ("n_words", "hits", "items")}
    return _search(docs, _saved(pieces, 1 + 2 * size // CHUNK_BYTES, width, store), store, [c for c in keep if c not in taken], text, prefix)
