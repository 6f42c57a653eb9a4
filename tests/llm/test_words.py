import random

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm import words
from lakeops.llm.words import LETTERED, MARKED, SPACED, Block, hash_words, small_blocks, window_hashes


@pytest.mark.parametrize("table", [SPACED, LETTERED])
def test_hashes_name_words(table):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abAB9 .\n\té漢") for _ in range(rng.randrange(60))) for _ in range(300)]
    block = Block([t.encode() for t in texts], table)
    named = {}
    for i, t in enumerate(texts):
        low = "".join(c.lower() if c.isascii() else c for c in t)
        kept = "".join(c if (not c.isspace() if table is SPACED else c.isalnum() or not c.isascii()) else " " for c in low).split()
        own = block.hashes[block.offsets[i]:block.offsets[i + 1]].tolist()
        assert len(own) == len(kept)
        for w, h in zip(kept, own):
            assert named.setdefault(w, h) == h
    assert len(set(named.values())) == len(named)


def test_kinds_of_runs_are_apart():
    assert len(Block([b"Ab1!!  x"], MARKED, lower=False).hashes) == 3


def test_pieces_do_not_change_words(monkeypatch):
    data = (b"some words and one" + b"x" * 5000 + b" more of them\n") * 3 + b"y" * 3000
    whole = hash_words(data, SPACED)
    monkeypatch.setattr(words, "PIECE", 64)
    for a, b in zip(whole, hash_words(data, SPACED)):
        assert np.array_equal(a, b)


def test_blocks_hold_all_rows():
    texts = [None, "", "a" * 50, "b", None, "c" * 5, "d" * 200]
    batch = pa.RecordBatch.from_pydict({"i": list(range(7)), "t": pa.array(texts, pa.string())})
    seen = [(i, t) for rows, part in small_blocks(iter([batch]), "t", 60) for i, t in zip(rows.column("i").to_pylist(), part)]
    assert seen == [(i, (t or "").encode()) for i, t in enumerate(texts)]


def test_windows():
    h = np.arange(1, 8, dtype=np.uint64)
    assert len(window_hashes(h, 5)) == 3 and len(window_hashes(h, 8)) == 0
    assert window_hashes(h, 2)[1] == window_hashes(h[1:3], 2)[0]
