"""Packing token ids into sequences of one size, shortest pack first over the histogram of lengths.

Every document is cut into pieces of the full size and one rest. What is packed is not
the pieces but the histogram of their lengths, which has no more rows than the size:
groups of equally filled sequences, each a pattern and a count, take the lengths from
the longest down, always into the shortest group. As many sequences are opened as the
ids fill, so a length that fits into none is cut: the shortest sequences are filled up
with its beginning, and the rest goes back to the histogram as a shorter length. All
sequences together are padded by less than one sequence.

The patterns go back to the documents by rank: a piece's rank among those of its length is
its rank in its own partition, counted as the partition is written, plus how many
of that length all earlier partitions hold. Ids never move between tasks.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lakeops.durable import fresh_path, materialize
from lakeops.llm.frames import as_text, free_prefix, lean, map_batches, map_texts, named
from lakeops.llm.store import Store
from lakeops.llm.words import SPACED, hash_words

SIZE = 2048
#: words a task keeps encoded; beyond it, it starts anew
KEPT = 600_000
#: words of letters that are encoded as one text
TOGETHER = 200
_RANK_BITS = np.uint64(48)


# --- token ids ----------------------------------------------------------------------------

def _ascii(is_in) -> np.ndarray:
    return np.array([b < 0x80 and is_in(chr(b)) for b in range(256)])


_ALNUM = _ascii(str.isalnum)
#: marks that start or end a pre-token beside a letter or digit; ' and | stand inside contractions and special tokens
_MARK = _ascii(lambda c: c.isprintable() and c != " " and not c.isalnum() and c not in "'|")


def _apart(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """All texts, a line end after each, with a space between letters or digits and marks; and where each text ends."""
    a = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    alnum, mark = _ALNUM[a], _MARK[a]
    at = np.flatnonzero(alnum[:-1] & mark[1:] | mark[:-1] & alnum[1:]) + 1
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return np.insert(a, at, 0x20).tobytes(), ends + np.searchsorted(at, ends)


class WordEncoder:
    """Ids of texts by a tokenizer that never looks across ASCII white space.

    It must also set ASCII letters and digits apart from ASCII marks other than ' and |, and read
    A-Z as a-z except in special tokens, which hold ``<|``. Texts are cut into words there; words are
    told apart by a 64-bit hash, each distinct one is encoded once, and texts are put
    together from the ids of their words.
    """

    def __init__(self, tokenizer: Tokenizer, end: int, kept: int = KEPT):
        self.tokenizer, self.end, self.kept = tokenizer, end, kept
        vocabulary = tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for name, i in vocabulary.items() if name.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        # word 0 is the end of a text
        self.flat = np.array([self.end], "<u4")
        self.at, self.len = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.hashes, self.words = np.empty(0, np.uint64), np.empty(0, np.int64)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), "<u4", int(lengths.sum())), lengths

    def _ids_of_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of ASCII letters: many as one text, cut where an id ends a word."""
        ids, _ = self._ids([" ".join(words[at:at + TOGETHER]) for at in range(0, len(words), TOGETHER)])
        last = np.flatnonzero(self.ends_word[ids])
        if len(last) != len(words):  # a tokenizer that does not mark the ends of words
            return self._ids(words)
        return ids, np.diff(last, prepend=-1)

    def _learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        plain = np.fromiter((t.isalpha() for t in texts), bool, len(texts))
        order = np.argsort(~plain, kind="stable")
        hashes, texts = hashes[order], [as_text(texts[i]) for i in order.tolist()]
        parts = self._ids_of_letters(texts[:plain.sum()]), self._ids(texts[plain.sum():])
        new, lengths = (np.concatenate(x) for x in zip(*parts))
        words = len(self.at) + np.arange(len(texts))
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(lengths) - lengths])
        self.len = np.concatenate([self.len, lengths])
        self.flat = np.concatenate([self.flat, new])
        order = np.argsort(hashes)
        place = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.words = np.insert(self.hashes, place, hashes[order]), np.insert(self.words, place, words[order])

    def _unknown(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] != hashes

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each text closed by the end, and how many each has."""
        data, ends_of_texts = _apart(texts)
        if b"<|" not in data:
            data = data.lower()
        hashes, starts, ends = hash_words(data, SPACED)
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > self.kept:
            self._forget()
        new = np.flatnonzero(self._unknown(distinct))
        if len(new):
            cuts = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._learn(distinct[new], [data[a:b] for a, b in cuts])
        # the words of each text, and its end
        upto = np.searchsorted(starts, ends_of_texts) + np.arange(1, len(texts) + 1)
        words = np.zeros(upto[-1], np.int64)
        of_text = np.ones(len(words), bool)
        of_text[upto - 1] = False
        words[of_text] = self.words[np.searchsorted(self.hashes, distinct)][place]
        lengths = self.len[words]
        after = np.cumsum(lengths)
        ids = self.flat[np.arange(after[-1]) - np.repeat(after - lengths - self.at[words], lengths)]
        return ids, np.diff(after[upto - 1], prepend=0)


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of ``data``, each of so many bytes, as an Arrow array that shares its memory."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    if offsets[-1] < 1 << 31:
        return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(data)])
    raw = data.tobytes()
    return pa.array([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())


def tokenise(docs: DataFrame, tokenizer: str, end: int, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The ``keep`` columns with ``ids``: the whole text's ids and ``end``, packed as little-endian unsigned 32-bit.

    ``tokenizer`` is the path of a tokenizer file that the driver reads; the file, of
    fixed size, is sent to the tasks; what it must hold to is said at ``WordEncoder``. Strings of its special tokens count as these, as the library has it. Null and empty texts
    hold the end alone. Rows are never moved.
    """
    with open(tokenizer, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def build():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = WordEncoder(Tokenizer.from_buffer(sent.value), end)

        def work(texts, rows):
            ids, counts = encoder.encode(texts)
            return [_binary(ids, 4 * counts)]
        return work

    return map_texts(docs, keep, text, "ids binary", build, prefix)


# --- packing the histogram ----------------------------------------------------------------

@dataclass(frozen=True)
class Plan:
    """Where ranks of a length go: row ``i`` takes ``taken`` ids of pieces of ``length`` from ``rank`` on.

    The piece of the k-th rank of a row lies in sequence ``sequence + k`` at ``offset``; what it
    has beyond ``taken`` ids goes on as the piece of rank ``rest + k`` of its length.
    """

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    taken: np.ndarray
    rest: np.ndarray
    sequences: int

    def keys(self) -> np.ndarray:
        return _keys(self.length, self.rank)


def _keys(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return length.astype(np.uint64) << _RANK_BITS | rank.astype(np.uint64)


def shortest_pack_first(histogram: dict[int, int], size: int) -> Plan:
    """Pack ``histogram`` (pieces by length, at most ``size`` each) into sequences of ``size``.

    Each step places as many pieces as the length and the shortest group both have, so
    the work and the plan grow with the number of lengths, not with that of pieces.
    """
    if size >= 1 << 16:
        raise ValueError("sequences of less than 65536 ids only")
    left = [0] * (size + 1)
    for length, n in histogram.items():
        if not 0 < length <= size:
            raise ValueError(f"no piece of {length} ids in sequences of {size}")
        left[length] += n
    sequences = -(-sum(length * n for length, n in enumerate(left)) // size)
    # groups of equally filled sequences: fill, first sequence, count
    groups, rows = [(0, 0, sequences)], []
    for length in range(size, 0, -1):
        rank = 0
        while rank < left[length]:
            fill, first, count = heapq.heappop(groups)
            n = min(count, left[length] - rank)
            taken = min(length, size - fill)
            rest = left[length - taken]
            rows.append((length, rank, first, fill, taken, rest))
            if taken < length:
                left[length - taken] += n
            if n < count:
                heapq.heappush(groups, (fill, first + n, count - n))
            if fill + taken < size:
                heapq.heappush(groups, (fill + taken, first, n))
            rank += n
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 6).T
    return Plan(*columns, sequences)


def place(plan: Plan, keys: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray, rank: np.ndarray):
    """``row, start, length, sequence, offset`` of the pieces after all cuts, in the order of row and start."""
    done = []
    while len(row):
        at = np.searchsorted(keys, _keys(length, rank), "right") - 1
        k, taken = rank - plan.rank[at], plan.taken[at]
        done.append((row, start, taken, plan.sequence[at] + k, plan.offset[at]))
        cut = np.flatnonzero(taken < length)
        row, start, length, rank = row[cut], start[cut] + taken[cut], length[cut] - taken[cut], (plan.rest[at] + k)[cut]
    if not done:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    parts = [np.concatenate(x) for x in zip(*done)]
    order = np.lexsort((parts[1], parts[0]))
    return tuple(x[order] for x in parts)


# --- documents ----------------------------------------------------------------------------

def _ranked(coded: DataFrame, keep: list[str], ids: str, size: int, p: str) -> DataFrame:
    """Adds the partition, the ids' number, and the ranks of the first full piece and of the rest in the partition."""
    source = coded.select(*[named(c) for c in keep], F.coalesce(named(ids), F.lit(b"")).alias(f"{p}ids"))
    added = [T.StructField(p + n, T.LongType()) for n in ("part", "tokens", "full", "rest")]
    schema = T.StructType([*source.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            tokens = _sizes(batch.column(len(keep))) // 4
            full, rest = tokens // size, tokens % size
            before = seen[size] + np.cumsum(full) - full
            # the rank of a rest: those of its length before it, in this batch and earlier
            order = np.argsort(rest, kind="stable")
            held = rest[order]
            begins = np.searchsorted(held, held)
            ranks = np.empty(len(rest), np.int64)
            ranks[order] = np.arange(len(rest)) - begins + seen[held]
            seen += np.bincount(rest, minlength=size + 1)
            seen[size] += full.sum()
            new = [np.full(len(rest), part, np.int64), tokens, before, ranks]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x) for x in new]], names=schema.names)

    return map_batches(source, run, schema)


def _sizes(column: pa.Array) -> np.ndarray:
    return pc.binary_length(column).to_numpy().astype(np.int64)


def _store_before(counts: DataFrame, store: Store, size: int) -> None:
    """For each partition a file: of each length, how many pieces lie in earlier partitions."""
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    @lean
    def write(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        held = np.zeros(size + 1, "<i8")
        held[table.column("length").to_numpy()] = table.column("before").to_numpy()
        store.write(f"before-{part}", held)
        return pa.table({"part": pa.array([part], pa.int64())})

    before.groupBy("part").applyInArrow(write, "part long").write.format("noop").mode("overwrite").save()


def pack(coded: DataFrame, keep: list[str], ids: str = "ids", size: int = SIZE, prefix: str = "") -> DataFrame:
    """Every piece of every row's packed ids, with the sequence it lies in.

    One row per piece: the ``keep`` columns, ``start`` (the row's ids before it), ``length``, its
    ``ids``, ``doc_tokens`` (all of the row's ids), ``sequence_id`` from 0 and ``offset`` there, with
    ``prefix`` before these names; a kept column of the same name gives way. Sequences hold their
    pieces without gaps. Null or empty ids have no piece. Rows that are equal are packed one by one.

    Driver: a row for each length, at most ``size``. Tasks: the plan, which grows with the
    number of lengths alone, and a file of ``size`` numbers for each partition they read.
    """
    out = [prefix + n for n in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")]
    keep = [c for c in keep if c.lower() not in out]
    spark, p = coded.sparkSession, free_prefix(coded)
    ranked = materialize(_ranked(coded, keep, ids, size, p), "ids")
    lengths = F.array(
        F.struct(F.lit(size).cast("long").alias("length"), F.floor(F.col(f"{p}tokens") / size).alias("n")),
        F.struct((F.col(f"{p}tokens") % size).alias("length"), F.lit(1).cast("long").alias("n")),
    )
    found = ranked.select(F.col(f"{p}part").alias("part"), F.explode(lengths).alias("x")).select("part", "x.*")
    counts = materialize(found.where("length > 0 AND n > 0").groupBy("part", "length").agg(F.sum("n").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = shortest_pack_first(histogram, size)
    store = Store(fresh_path(spark, "packing"))
    _store_before(counts, store, size)
    sent = spark.sparkContext.broadcast(plan)

    fields = {f.name: f for f in ranked.schema.fields}
    kinds = [T.LongType(), T.LongType(), T.BinaryType(), T.LongType(), T.LongType(), T.LongType()]
    schema = T.StructType([*[fields[c] for c in keep], *[T.StructField(n, k) for n, k in zip(out, kinds)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = sent.value
        keys, held = plan.keys(), {}
        for batch in batches:
            part, tokens, full, rest = (batch.column(len(keep) + 1 + i).to_numpy() for i in range(4))
            before = np.empty((len(batch), 2), np.int64)
            for k in np.unique(part).tolist():
                if k not in held:  # a partition's rows come one after the other
                    held = {k: np.array(store.open(f"before-{k}", "<i8"))}
                of = part == k
                before[of] = np.stack([np.full(of.sum(), held[k][size]), held[k][tokens[of] % size]], axis=1)
            n_full, short = tokens // size, tokens % size
            row = np.repeat(np.arange(len(batch)), n_full)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n_full) - n_full, n_full)
            last = np.flatnonzero(short)
            row, start, length, sequence, offset = place(
                plan, keys, np.concatenate([row, last]), np.concatenate([nth * size, (n_full * size)[last]]),
                np.concatenate([np.full(len(nth), size), short[last]]),
                np.concatenate([(before[:, 0] + full)[row] + nth, (before[:, 1] + rest)[last]]),
            )
            packed = batch.column(len(keep))
            flat = np.frombuffer(b"".join(packed.to_pylist()), np.uint8)
            # pieces in the order of row and start lie in the ids one after the other; bytes beyond whole ids are left out
            made = [pa.array(start), pa.array(length), _binary(flat, 4 * length), pa.array(tokens[row]), pa.array(sequence), pa.array(offset)]
            kept = batch.select(list(range(len(keep)))).take(pa.array(row)) if keep else None
            yield pa.RecordBatch.from_arrays([*(kept.columns if keep else []), *made], names=schema.names)

    columns = [*[named(c) for c in keep], *[f"{p}{n}" for n in ("ids", "part", "tokens", "full", "rest")]]
    return map_batches(ranked.where(F.col(f"{p}tokens") > 0).select(*columns), run, schema)


def sequences(pieces: DataFrame, prefix: str = "") -> DataFrame:
    """``sequence_id``, its ``ids`` in the order of their offsets, and where in it each piece begins (``starts``).

    Groups hold one sequence, so at most its size of ids.
    """
    c = {n: named(prefix + n) for n in ("sequence_id", "offset", "ids")}
    held = F.sort_array(F.collect_list(F.struct(c["offset"].alias("offset"), c["ids"].alias("ids"))))
    return pieces.groupBy(c["sequence_id"].alias("sequence_id")).agg(held.alias("held")).select(
        "sequence_id", F.unhex(F.array_join(F.transform("held", lambda x: F.hex(x["ids"])), "")).alias("ids"),
        F.col("held.offset").alias("starts"),
    )
