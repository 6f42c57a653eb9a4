"""Quality classifier: logistic regression on hashed word n-grams.

A text is cut into runs of letters and digits and runs of other characters. Its
features are the hashes of words and word pairs, once of the words themselves and
once of their shapes (length, case, kind, repetition), so that words never seen in
training still count. Weights come from follow-the-regularised-leader updates over
the labelled rows; a text's score is one sparse dot product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.frames import lean, map_texts, named
from lakeops.llm.words import MARKED, Block, mix, small_blocks

_PAIR = np.uint64(0x9DDFEA08EB382D69)
_SHAPE = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Settings:
    """``most_rows`` bounds the labelled rows that are fitted; ``shards`` fits run side by side."""

    bits: int = 18
    most_rows: int = 16_000
    shards: int = 4
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 1.0


def features(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices of some texts, one text after the other, and how many each has."""
    block = Block(texts, MARKED, lower=False)
    n = len(block.hashes)
    if not n:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    data = np.frombuffer(block.data, np.uint8)
    first, last = data[block.starts], data[block.ends - 1]
    length = np.minimum(np.log2(block.ends - block.starts + 1) * 2, 30).astype(np.uint64)
    owner = block.owners()
    same = np.zeros(n, dtype=np.uint64)
    same[1:] = (block.hashes[1:] == block.hashes[:-1]) & (owner[1:] == owner[:-1])
    same[2:] |= ((block.hashes[2:] == block.hashes[:-2]) & (owner[2:] == owner[:-2])).astype(np.uint64) << np.uint64(1)
    kinds = _KINDS[first].astype(np.uint64) << np.uint64(4) | _KINDS[last].astype(np.uint64)
    shapes = mix(_SHAPE + (length << np.uint64(16) | kinds << np.uint64(4) | same))
    found = [block.hashes, shapes]
    joined = owner[1:] == owner[:-1]
    of = [owner, owner]
    for stream in (block.hashes, shapes):
        found.append(mix(stream[:-1] * _PAIR + stream[1:])[joined])
        of.append(owner[1:][joined])
    index = (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)
    owners = np.concatenate(of)
    return index[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(texts))


#: digits, small letters, capitals, beyond ASCII, each other character by its value modulo 11
_KINDS = np.array([
    0 if 0x30 <= b <= 0x39 else 1 if 0x61 <= b <= 0x7A else 2 if 0x41 <= b <= 0x5A else 3 if b >= 0x80 else 4 + b % 11
    for b in range(256)
], dtype=np.uint8)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Leader:
    """Follow-the-regularised-leader state, one coordinate for each bucket and a bias."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.z = np.zeros((1 << settings.bits) + 1)
        self.n = np.zeros_like(self.z)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        free = np.sign(z) * np.maximum(np.abs(z) - self.s.l1, 0)
        return -free / ((self.s.beta + np.sqrt(n)) / self.s.alpha + self.s.l2)

    def update(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = (sigmoid(float(w @ x)) - label) * x
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = grown


def fit(labelled: DataFrame, text: str = "text", label: str = "label", key: str = "key", settings: Settings = Settings()) -> np.ndarray:
    """Weights from rows of a text and a 0/1 ``label``; ``key`` deals them into shards.

    Each shard is fitted by itself, in the order of the hash of its texts, and the
    weights are averaged. The caller bounds the rows (see ``sample_labels``), so a
    shard's texts fit a task. Rows with a null label are left out; without rows all
    weights are 0 and every score is 0.5.
    """
    rows = labelled.where(named(label).isNotNull()).select(
        F.pmod(F.xxhash64(named(key)), F.lit(settings.shards)).alias("shard"),
        F.xxhash64(named(key), named(text)).alias("at"),
        F.coalesce(named(text).cast("string"), F.lit("")).alias("text"), named(label).cast("double").alias("label"),
    )

    @lean
    def train(rows: pa.Table) -> pa.Table:
        table = rows.combine_chunks().sort_by([("at", "ascending"), ("label", "ascending")])
        leader, bias = Leader(settings), 1 << settings.bits
        samples, labels = [], []
        for batch, texts in small_blocks(iter(table.select(["text", "label"]).to_batches()), "text"):
            index, counts = features(texts, settings.bits)
            ends = np.cumsum(counts)
            for y, a, b in zip(batch.column("label").to_pylist(), ends - counts, ends):
                at, seen = np.unique(index[a:b], return_counts=True)
                samples.append((np.append(at, bias), np.append(seen / np.sqrt(max(b - a, 1)), 1.0)))
                labels.append(y)
        for _ in range(settings.epochs):
            for (at, x), y in zip(samples, labels):
                leader.update(at, x, y)
        return pa.table({"weights": [leader.weights().astype(np.float32).tobytes()], "rows": [len(labels)]})

    # one row for each shard
    made = rows.groupBy("shard").applyInArrow(train, "weights binary, rows long").collect()
    total = np.zeros((1 << settings.bits) + 1)
    for r in made:
        total += np.frombuffer(r["weights"], np.float32) * r["rows"]
    return (total / max(1, sum(r["rows"] for r in made))).astype(np.float32)


def sample_labels(labels: DataFrame, key: str, label: str, settings: Settings = Settings()) -> DataFrame:
    """One row for each labelled key, about ``most_rows`` at most, chosen by a hash of the key.

    A key that is labelled more than once takes the more frequent label, and 1 in a
    tie. Null keys and labels are left out. Columns ``key`` and ``label``.
    """
    single = labels.where(named(key).isNotNull() & named(label).isNotNull()).groupBy(named(key).alias("key")).agg(
        (F.avg(named(label).cast("double")) >= 0.5).cast("int").alias("label")
    )
    buckets = 1 << 30
    share = settings.most_rows / max(settings.most_rows, labels.count())
    return single.where(F.pmod(F.xxhash64("key"), F.lit(buckets)) < int(share * buckets) + 1)


def score(docs: DataFrame, weights: np.ndarray, keep: list[str], text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The ``keep`` columns with ``score``, the probability of label 1 of the whole text.

    A null or empty text has no words and scores by the bias alone.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def build():
        w = sent.value

        def work(texts, rows):
            index, counts = features(texts, settings.bits)
            sums = np.concatenate([[0.0], np.cumsum(w[index], dtype=np.float64)])
            ends = np.cumsum(counts)
            return [sigmoid((sums[ends] - sums[ends - counts]) / np.sqrt(np.maximum(counts, 1)) + float(w[-1]))]
        return work

    return map_texts(docs, keep, text, "score double", build)
