"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Texts are joined with line ends between them, A-Z are lower-cased, and the bytes
are cut into words by a table of word bytes. A word's hash comes from differences
of one running sum over the bytes, so no Python code runs per word. The bytes are
worked through in pieces that end between words, which bounds the memory a very
long text needs to its words' arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
BLOCK_BYTES = 2 << 20

_ODD = 0x9E3779B97F4A7C15 | 5
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base & _MASK, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_POWERS = _powers(_ODD, PIECE + 1)
_INVERSE = _powers(pow(_ODD, -1, 1 << 64), PIECE + 1)


def _bytes_table(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)])


#: words without white space: everything but 0x20 and 0x09-0x0D
SPACED = _bytes_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: words of letters and digits: 0-9, a-z and every byte of a character beyond ASCII
LETTERED = _bytes_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: runs of letters and digits (1) and runs of other visible characters (2)
MARKED = np.where(SPACED, np.where(LETTERED | _bytes_table(lambda b: 0x41 <= b <= 0x5A), 1, 2), 0).astype(np.uint8)


def _piece_words(a: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(a) + 2, dtype=table.dtype)
    np.take(table, a, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if table.dtype == bool:
        starts, ends = edges[::2], edges[1::2]
    else:
        named = inside[edges[:-1] + 1] != 0
        starts, ends = edges[:-1][named], edges[1:][named]
    sums = np.empty(len(a) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_LETTERS[a] * _POWERS[: len(a)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _INVERSE[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), starts, ends


def _long_word(a: np.ndarray) -> np.uint64:
    """The hash of one word longer than a piece: its pieces' sums, moved into place."""
    total = 0
    for at in range(0, len(a), PIECE):
        part = a[at:at + PIECE]
        total += int((_LETTERS[part] * _POWERS[: len(part)]).sum()) * pow(_ODD, at, 1 << 64)
    return mix(np.array([(total + len(a)) & _MASK], dtype=np.uint64))[0]


def hash_words(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash, start and end byte of every word of lower-cased ``data``."""
    a = np.frombuffer(data, dtype=np.uint8)
    found, at = [], 0
    while at < len(a):
        stop = min(at + PIECE, len(a))
        if stop < len(a):
            gaps = np.flatnonzero(table[a[at:stop]] == 0)
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:
                end = stop
                while end < len(a) and table[a[end:end + PIECE]].all():
                    end = min(end + PIECE, len(a))
                if end < len(a):
                    end += int(np.argmin(table[a[end:end + PIECE]]))
                found.append((np.array([_long_word(a[at:end])]), np.array([at]), np.array([end])))
                at = end
                continue
        h, s, e = _piece_words(a[at:stop], table)
        found.append((h, s + at, e + at))
        at = stop
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


class Block:
    """The words of some texts: ``hashes``, byte bounds, and ``offsets`` of each text's first word."""

    def __init__(self, texts: list[bytes], table: np.ndarray, lower: bool = True):
        self.data = b"\n".join(texts)
        if lower:
            self.data = self.data.lower()
        self.hashes, self.starts, self.ends = hash_words(self.data, table)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.offsets = np.searchsorted(self.starts, begins)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owners(self) -> np.ndarray:
        """For each word the place of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def small_blocks(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The rows of ``batches`` in order, a few at a time, with their texts as UTF-8 bytes; null is empty.

    A part holds about ``most`` bytes, or one longer text.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
        upto = np.concatenate([[0], np.cumsum(sizes.astype(np.int64) + 1)])
        first = 0
        while first < len(batch):
            after = int(np.searchsorted(upto, upto[first] + most, "right")) - 1
            after = max(first + 1, after)
            part = batch.slice(first, after - first)
            yield part, [v or b"" for v in part.column(text).cast(pa.binary()).to_pylist()]
            first = after


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        total = total * np.uint64(_ODD) + hashes[k:k + n]
    return mix(total)
