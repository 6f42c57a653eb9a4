"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

The vocabulary is the sorted array of its words' hashes; a word's number is its place.
A bigram is the number of its first word times the size of the vocabulary, plus that of
its second. Bigrams are counted in ranges of these numbers, cut where the word counts
say that each range has as many occurrences, also in the midst of a frequent word. Each
range is stored as a sorted array beside its counts, and with it how many continuations
its first words have. Workers map the arrays and look up sorted batches.

Every text is its words, lower-cased, and one end; the word before the first is a start
that is never predicted. Words never seen in training share the uniform part of the
lowest order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.durable import fresh_path, materialize
from lakeops.llm.frames import TEXT, bound_batches, lean, map_texts, named
from lakeops.llm.store import Store
from lakeops.llm.words import SPACED, Block, small_blocks

END = np.uint64(0x5851F42D4C957F2D)
#: words of one vocabulary file, and occurrences of one range of bigrams
SHARD_WORDS = 4_000_000
RANGE_TOKENS = 8_000_000
BLOCK_TOKENS = 1_500_000
BATCH_BYTES = 6 << 20
ADD = 0.1


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all texts' words, an end after each text, and where each text begins."""
    block = Block(texts, SPACED)
    counts = block.counts + 1
    offsets = np.concatenate([[0], np.cumsum(counts)])
    out = np.full(offsets[-1], END, np.uint64)
    words = np.ones(offsets[-1], bool)
    words[offsets[1:] - 1] = False
    out[words] = block.hashes
    return out, offsets


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


# --- the vocabulary -----------------------------------------------------------------------

def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (hash) and ``n`` for every token of the texts in column ``TEXT``."""
    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, part in small_blocks(batches, TEXT):
            held.append(np.unique(_tokens(part)[0], return_counts=True))
            size += len(held[-1][0])
            if size > 2_000_000:
                held = [_added(held)]
                size = len(held[0][0])
                if size > 1_000_000:
                    yield batch(held.pop())
                    size = 0
        if held:
            yield batch(_added(held))

    def batch(pair):
        return pa.RecordBatch.from_arrays([pa.array(_signed(pair[0])), pa.array(pair[1].astype(np.int64))], names=["word", "n"])

    return texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of counts by key, sorted by key."""
    keys = np.concatenate([k for k, _ in held])
    counts = np.concatenate([c for _, c in held])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


@dataclass
class Model:
    """What a worker needs to find its way in the files."""

    store: Store
    shards: int
    offsets: list[int]  # the number of the first word of each vocabulary file
    words: int = 0
    tokens: int = 0
    bounds: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # where each range but the first begins
    count_kinds: list[str] = field(default_factory=list)
    discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    low_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    pairs: int = 0
    low_classes: tuple[int, int, int] = (0, 0, 0)

    @property
    def base(self) -> int:
        """Words and the start, whose number is ``words``."""
        return self.words + 1


def _shard_of(word: Column, shards: int) -> Column:
    """Ranges of the unsigned hash, in order."""
    # the sign bit turned, the hash's order is that of signed numbers; its high 31 bits
    high = F.shiftrightunsigned(word, 33)
    return F.floor(high * F.lit(shards) / F.lit(1 << 31)).cast("int")


def _vocabulary(counts: DataFrame, model: Model) -> list[dict]:
    """Writes the sorted files; a row for each: how many words, and where ranges should be cut."""
    store = model.store

    @lean
    def write(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        words, n = table.column("word").to_numpy().view(np.uint64), table.column("n").to_numpy()
        order = np.argsort(words)
        store.write(f"word-{part}", words[order])
        store.write(f"seen-{part}", n[order].astype("<u8"))
        total = np.cumsum(n[order])
        cuts = np.arange(RANGE_TOKENS, total[-1], RANGE_TOKENS)
        at = np.searchsorted(total, cuts, "left")
        share = (cuts - (total[at] - n[order][at])) / n[order][at]
        return pa.table({"part": [part], "words": [len(words)], "at": [at.tolist()], "share": [share.tolist()]},
                        schema=pa.schema([("part", pa.int32()), ("words", pa.int64()), ("at", pa.list_(pa.int64())), ("share", pa.list_(pa.float64()))]))

    made = counts.withColumn("part", _shard_of(F.col("word"), model.shards)).groupBy("part").applyInArrow(
        write, "part int, words long, at array<long>, share array<double>"
    )
    return [r.asDict() for r in made.collect()]  # a row for each file


class Words:
    """The vocabulary's files in one worker."""

    def __init__(self, model: Model):
        self.model = model
        self.hashes = [model.store.open(f"word-{p}", "<u8") if n else np.empty(0, "<u8") for p, n in enumerate(np.diff([*model.offsets, model.words]))]
        self.seen = [model.store.open(f"seen-{p}", "<u8") if n else np.empty(0, "<u8") for p, n in enumerate(np.diff([*model.offsets, model.words]))]

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unknown) and counts of sorted hashes."""
        ids, counts = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64)
        shard = ((words >> np.uint64(33)) * np.uint64(self.model.shards) >> np.uint64(31)).astype(np.int64)
        cuts = np.searchsorted(shard, np.arange(self.model.shards + 1))
        for p, known in enumerate(self.hashes):
            a, b = cuts[p], cuts[p + 1]
            if a < b and len(known):
                at = np.searchsorted(known, words[a:b])
                at[at == len(known)] = 0
                hit = known[at] == words[a:b]
                ids[a:b] = np.where(hit, at + self.model.offsets[p], -1)
                counts[a:b] = np.where(hit, self.seen[p][at].astype(np.int64), 0)
        return ids, counts


def _numbered(words: Words, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every token its number and count, the number of the word before, and the texts' offsets."""
    tokens, offsets = _tokens(texts)
    unique, inverse = np.unique(tokens, return_inverse=True)
    ids, counts = words.find(unique)
    second, seen = ids[inverse], counts[inverse]
    first = np.empty_like(second)
    first[1:] = second[:-1]
    first[offsets[:-1]] = words.model.words  # the start
    return first, second, seen, offsets


# --- the bigrams ------------------------------------------------------------------------------

def _pack(keys: np.ndarray, counts: np.ndarray, low: int) -> bytes:
    gaps = np.diff(keys, prepend=np.uint64(low))
    raw = np.ascontiguousarray(gaps).view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(data: bytes, low: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(raw) // 12
    gaps = raw[:8 * n].reshape(8, n).T.copy().view("<u8").ravel()
    counts = raw[8 * n:].reshape(4, n).T.copy().view("<u4").ravel()
    gaps[:1] += np.uint64(low)
    return np.cumsum(gaps, dtype=np.uint64), counts


def _count_pairs(texts: DataFrame, model: Model) -> DataFrame:
    """Distinct bigrams of blocks of texts with their counts, packed for each range."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, base = Words(model), np.uint64(model.base)
        held, size = [], 0

        def flush():
            keys, counts = _added(held)
            cuts = [0, *np.searchsorted(keys, model.bounds).tolist(), len(keys)]
            lows = [0, *model.bounds.tolist()]
            for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r], pa.int32()), pa.array([_pack(keys[a:b], counts[a:b], lows[r])], pa.binary())], names=["part", "blob"]
                    )

        for _, part in small_blocks(batches, TEXT):
            first, second, _, _ = _numbered(words, part)
            held.append(np.unique(first.astype(np.uint64) * base + second.astype(np.uint64), return_counts=True))
            size += len(held[-1][0])
            if size > BLOCK_TOKENS:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return texts.mapInArrow(run, "part int, blob binary")


def _store_pairs(packed: DataFrame, model: Model) -> DataFrame:
    """Writes each range's bigrams; returns its counts of counts, and for each word the different words before it."""
    store, shards = model.store, model.shards

    @lean
    def merge(table: pa.Table) -> pa.Table:
        r = table.column("part")[0].as_py()
        low = 0 if r == 0 else int(model.bounds[r - 1])
        held = []
        for data in table.column("blob").to_pylist():
            held.append(_unpack(data, low))
            if sum(len(k) for k, _ in held) > 3 * RANGE_TOKENS:
                held = [_added(held)]
        keys, counts = _added(held)
        first, second = keys // np.uint64(model.base), keys % np.uint64(model.base)
        kind = "<u2" if counts.max(initial=0) < 1 << 16 else "<u4"
        store.write(f"pair-{r}", keys)
        store.write(f"times-{r}", counts.astype(kind))
        begins = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        store.write(f"context-{r}", first[begins])
        for j in (1, 2, 3):
            some = (counts == j) if j < 3 else (counts >= 3)
            store.write(f"follow{j}-{r}", np.add.reduceat(some.astype(np.uint32), begins).astype("<u4"))
        rows = {"kind": [0], "part": [r], "blob": [np.array([len(keys), len(begins), np.dtype(kind).itemsize, *[(counts == j).sum() for j in (1, 2, 3, 4)]], "<u8").tobytes()]}
        # the different words before each word, for the files of the vocabulary
        seconds, before = np.unique(second, return_counts=True)
        cuts = np.searchsorted(seconds, np.array([*model.offsets, model.words], np.uint64))
        for p in range(shards):
            a, b = cuts[p], cuts[p + 1]
            if a < b:
                rows["kind"].append(1)
                rows["part"].append(p)
                rows["blob"].append(_pack(seconds[a:b], before[a:b], 0))
        return pa.table({"kind": pa.array(rows["kind"], pa.int32()), "part": pa.array(rows["part"], pa.int32()), "blob": pa.array(rows["blob"], pa.binary())})

    return packed.groupBy("part").applyInArrow(merge, "kind int, part int, blob binary")


def _store_before(found: DataFrame, model: Model) -> list[dict]:
    """Writes, for each word, how many different words come before it; a row of sums for each file."""
    store, ends = model.store, [*model.offsets[1:], model.words]

    @lean
    def merge(table: pa.Table) -> pa.Table:
        p = table.column("part")[0].as_py()
        dense = np.zeros(ends[p] - model.offsets[p], np.uint32)
        for data in table.column("blob").to_pylist():
            seconds, n = _unpack(data, 0)
            dense[seconds.astype(np.int64) - model.offsets[p]] += n
        store.write(f"before-{p}", dense)
        sums = [int(dense.sum()), *[int((dense == j).sum()) for j in (1, 2, 3, 4)], int((dense >= 3).sum())]
        return pa.table({"sums": pa.array([sums], pa.list_(pa.int64()))})

    return [r["sums"] for r in found.where("kind = 1").groupBy("part").applyInArrow(merge, "sums array<long>").collect()]


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts from the counts of counts; a half, one and one and a half where they are missing."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.0), j) for j, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))


def fit(docs: DataFrame, text: str = "text") -> Model:
    """A model of all texts (null: empty), stored below the session's shared folder.

    Without any text the model has no words and every token is unknown. The driver sees
    a row for each file, never the words. A vocabulary of 2^32 words is too large.
    """
    spark = docs.sparkSession
    texts = bound_batches(docs).select(named(text).cast("string").alias(TEXT))
    counts = materialize(word_counts(texts), "words")
    size = counts.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    shards = max(1, -(-size["words"] // SHARD_WORDS))
    model = Model(Store(fresh_path(spark, "model")), shards, [0] * shards, size["words"], size["tokens"])
    if not model.words:
        return model
    if model.words >= (1 << 32) - 1:
        raise ValueError(f"{model.words} words are too many")
    made = {r["part"]: r for r in _vocabulary(counts, model)}
    lengths = [made[p]["words"] if p in made else 0 for p in range(shards)]
    model.offsets = [int(x) for x in np.concatenate([[0], np.cumsum(lengths)[:-1]])]
    bounds = [
        (model.offsets[p] + a) * model.base + min(int(s * model.base), model.words)
        for p in sorted(made) for a, s in zip(made[p]["at"], made[p]["share"])
    ]
    # the start comes before one word of each text
    starts = docs.count() // RANGE_TOKENS
    bounds += [model.words * model.base + int(model.base * j / (starts + 1)) for j in range(starts + 1)]
    model.bounds = np.unique(np.array(bounds, np.uint64))
    found = materialize(_store_pairs(_count_pairs(texts, model), model), "pairs")
    sums = np.zeros(4, np.int64)
    model.count_kinds = [""] * (len(model.bounds) + 1)
    for r in found.where("kind = 0").collect():  # a row for each range
        total, _, width, *times = np.frombuffer(r["blob"], "<u8").tolist()
        model.count_kinds[r["part"]] = f"<u{width}"
        model.pairs += total
        sums += times
    model.discounts = _discounts(*sums.tolist())
    low = np.sum(_store_before(found, model), axis=0).tolist()
    model.low_discounts = _discounts(*low[1:5])
    model.low_classes = (low[1], low[2], low[5])
    return model


# --- scores -----------------------------------------------------------------------------------

class Scorer:
    """Looks sorted batches up in the mapped files."""

    def __init__(self, model: Model):
        self.m, self.words = model, Words(model)
        lengths = np.diff([*model.offsets, model.words])
        self.before = [model.store.open(f"before-{p}", "<u4") if n else np.empty(0, "<u4") for p, n in enumerate(lengths)]
        self.ranges: dict[int, tuple] = {}

    def _range(self, r: int):
        if r not in self.ranges:
            o = self.m.store.open
            self.ranges[r] = (
                o(f"pair-{r}", "<u8"), o(f"times-{r}", self.m.count_kinds[r]), o(f"context-{r}", "<u8"),
                [o(f"follow{j}-{r}", "<u4") for j in (1, 2, 3)],
            )
        return self.ranges[r]

    def _followers(self, contexts: np.ndarray) -> np.ndarray:
        """Three rows: words that followed each of the sorted contexts once, twice, more often."""
        out = np.zeros((3, len(contexts)))
        low = np.searchsorted(self.m.bounds, contexts.astype(np.uint64) * np.uint64(self.m.base), "right")
        high = np.searchsorted(self.m.bounds, contexts.astype(np.uint64) * np.uint64(self.m.base) + np.uint64(self.m.words), "right")
        for r, kind in enumerate(self.m.count_kinds):
            # a frequent word's bigrams lie in several ranges
            a, b = np.searchsorted(high, r, "left"), np.searchsorted(low, r, "right")
            if kind and a < b:
                _, _, known, follow = self._range(r)
                at = np.searchsorted(known, contexts[a:b].astype(np.uint64))
                at[at == len(known)] = 0
                hit = known[at] == contexts[a:b].astype(np.uint64)
                for j in range(3):
                    out[j, a:b] += np.where(hit, follow[j][at], 0)
        return out

    def _times(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted bigrams."""
        out = np.zeros(len(keys))
        cuts = [0, *np.searchsorted(keys, self.m.bounds).tolist(), len(keys)]
        for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b and self.m.count_kinds[r]:
                known, times, _, _ = self._range(r)
                at = np.searchsorted(known, keys[a:b])
                at[at == len(known)] = 0
                out[a:b] = np.where(known[at] == keys[a:b], times[at], 0)
        return out

    def _lowest(self, ids: np.ndarray) -> np.ndarray:
        """The lowest order's probability of each number; -1 is unknown."""
        m = self.m
        if not m.words:
            return np.ones(len(ids))
        before = np.zeros(len(ids))
        for p, dense in enumerate(self.before):
            mine = (ids >= m.offsets[p]) & (ids < m.offsets[p] + len(dense))
            before[mine] = dense[ids[mine] - m.offsets[p]]
        d = np.array([0.0, *m.low_discounts])
        left = sum(x * n for x, n in zip(m.low_discounts, m.low_classes)) / m.pairs
        return np.maximum(before - d[np.minimum(before, 3).astype(np.int64)], 0) / m.pairs + left / (m.words + 1)

    def score(self, texts: list[bytes]) -> list[np.ndarray]:
        """Tokens, known tokens, base and model log10 probability of each text."""
        m = self.m
        first, second, seen, offsets = _numbered(self.words, texts)
        ids, place = np.unique(second, return_inverse=True)
        p = self._lowest(ids)[place]
        # a start has as many followers as there are training texts, a word as many as it was seen
        contexts, at = np.unique(first, return_inverse=True)
        total = np.zeros(len(first))
        total[1:] = seen[:-1]
        starts = self._starts()
        total[offsets[:-1]] = starts
        known = contexts >= 0
        follow = np.zeros((3, len(contexts)))
        follow[:, known] = self._followers(contexts[known])
        left = (np.array(m.discounts) @ follow)[at]
        some = total > 0
        p[some] *= left[some] / total[some]
        pair = np.flatnonzero((first >= 0) & (second >= 0) & some)
        keys, back = np.unique(first[pair].astype(np.uint64) * np.uint64(m.base) + second[pair].astype(np.uint64), return_inverse=True)
        times = self._times(keys)[back]
        d = np.array([0.0, *m.discounts])
        p[pair] += np.maximum(times - d[np.minimum(times, 3).astype(np.int64)], 0) / total[pair]
        base = np.log10((seen + ADD) / (m.tokens + ADD * (m.words + 1)))
        sums = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[offsets])
        return [np.diff(offsets), sums(seen > 0).astype(np.int64), sums(base), sums(np.log10(p))]

    def _starts(self) -> float:
        """Training texts: as many as ends were seen."""
        return float(self.words.find(np.array([END]))[1][0])


RESULT = "n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The ``keep`` columns with ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of each whole text.

    ``score`` is the log10 probability of the text's words and its end, ``base_score`` that
    of a unigram model with 0.1 added to each count; null and empty texts are their end.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def build():
        scorer = Scorer(sent.value)
        return lambda texts, rows: scorer.score(texts)

    return map_texts(docs, keep, text, RESULT, build, prefix, BATCH_BYTES)


def perplexity(score: Column, n_tokens: Column) -> Column:
    """Of a text, from its log10 probability."""
    return F.pow(F.lit(10.0), -score / n_tokens)
