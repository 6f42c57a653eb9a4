"""Byte-level BPE through a sentencepiece model made directly from a vocabulary.

A rank file lists byte strings and their ranks. Every byte becomes one character
(its value plus 256), every vocabulary entry a piece with minus its rank as score,
and the pieces are written as a sentencepiece BPE model with identity normalisation.
Merging the best-scored neighbours is then merging the lowest rank first. Texts are
cut into pre-tokens by a pattern, distinct pre-tokens are encoded once, and ids are
turned back through the inverse mapping.
"""

from __future__ import annotations

import base64
import struct
from dataclasses import dataclass
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeops.llm.frames import as_text, map_batches, map_texts, named

#: pre-tokens a task keeps encoded; beyond it, it starts anew
KEPT = 150_000
#: pre-tokens of one text that are handled at a time
STEP = 200_000
BYTE_CHARACTERS = 256


@dataclass(frozen=True)
class Vocabulary:
    """A serialised model, the byte string of each piece, and each piece's id."""

    model: bytes
    pieces: list[bytes]
    ids: list[int]
    pattern: str


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    return _bytes(1, _bytes(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))


def mapped(data: bytes) -> str:
    return (np.frombuffer(data, np.uint8).astype("<u2") + BYTE_CHARACTERS).tobytes().decode("utf-16-le")


def serialise(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
    """A model of ``ranks``, whose byte strings must hold all single bytes that occur."""
    ordered = sorted(ranks.items(), key=lambda x: x[1])
    normal, unknown, bpe = 1, 2, 2  # fixed values of the model format
    model = b"".join(_piece(mapped(data), -float(rank), normal) for data, rank in ordered)
    model += _piece("<unk>", 0.0, unknown)
    model += _bytes(2, _number(3, bpe) + _number(4, len(ordered) + 1) + _number(40, len(ordered)))
    # identity: no prefix, no removal and no escaping of spaces
    model += _bytes(3, _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return Vocabulary(model, [d for d, _ in ordered], [r for _, r in ordered], pattern)


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of a byte string in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Encoder:
    """Encodes in one task; ``kept`` pre-tokens stay encoded."""

    def __init__(self, vocabulary: Vocabulary, kept: int = KEPT):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model)
        self.pattern = regex.compile(vocabulary.pattern)
        self.whole = {data: struct.pack("<I", i) for data, i in zip(vocabulary.pieces, vocabulary.ids)}
        self.ids = np.array([*vocabulary.ids, 0], dtype="<u4")
        self.unknown = len(vocabulary.ids)
        self.kept = kept
        self.known: dict[str, bytes] = {}

    def _learn(self, tokens: set[str]) -> None:
        rest, raw = [], []
        for token in tokens:
            data = token.encode()
            found = self.whole.get(data)
            if found is None:
                rest.append(token)
                raw.append(data)
            else:
                self.known[token] = found
        # mapped to characters in one go, and cut again
        ends = list(accumulate(map(len, raw)))
        text = mapped(b"".join(raw))
        places = self.model.encode([text[a:b] for a, b in zip([0, *ends], ends)], num_threads=1)
        flat = np.fromiter(chain.from_iterable(places), np.int64)
        if (flat == self.unknown).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        packed, at = self.ids[flat].tobytes(), 0
        for token, found in zip(rest, places):
            upto = at + 4 * len(found)
            self.known[token] = packed[at:upto]
            at = upto

    def _packed(self, tokens: list[str]) -> bytes:
        # looks up each new token; difference_update would walk over all known ones
        new = set(tokens).difference(self.known)
        if len(self.known) + len(new) > self.kept:
            self.known.clear()
            new = set(tokens)
        if new:
            self._learn(new)
        return b"".join(map(self.known.__getitem__, tokens))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if len(text) <= STEP:
            return self._packed(self.pattern.findall(text))
        found, parts = (m.group() for m in self.pattern.finditer(text)), []
        while tokens := list(islice(found, STEP)):
            parts.append(self._packed(tokens))
        return b"".join(parts)


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The ``keep`` columns with ``ids``: the whole text's ids, packed as little-endian unsigned 32-bit.

    Null and empty texts have no ids. The vocabulary, of fixed size, is sent to the tasks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def build():
        encoder = Encoder(sent.value)
        return lambda texts, rows: [[encoder.encode(as_text(t)) for t in texts]]

    return map_texts(docs, keep, text, "ids binary", build, prefix)


def decode(coded: DataFrame, vocabulary: Vocabulary, keep: list[str], ids: str = "ids") -> DataFrame:
    """The ``keep`` columns with ``decoded``, the bytes that packed ``ids`` stand for; null ids stand for none."""
    sent = coded.sparkSession.sparkContext.broadcast(vocabulary)
    keep = [c for c in keep if c.lower() != "decoded"]
    source = coded.select(*[named(c) for c in keep], named(ids).alias("__ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.BinaryType())])
    names, ids_at = schema.names, len(keep)

    def run(batches):
        table = dict(zip(sent.value.ids, sent.value.pieces))
        for batch in batches:
            at = 0
            while at < len(batch):  # a few rows at a time, as the bytes are about as long as the ids
                rows = batch.slice(at, 256)
                texts = [
                    b"".join(map(table.__getitem__, np.frombuffer(x or b"", "<u4").tolist()))
                    for x in rows.column(ids_at).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(texts, pa.binary())], names=names)
                at += 256

    return map_batches(source, run, schema)
