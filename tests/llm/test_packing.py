"""Token ids packed into sequences of one size."""

import collections
import random
import struct

import public_tokenizers
import pytest
from llm_data import ENGLISH, GERMAN, documents, odd, sentence  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [
    "a,'s ,'s x≠y (It's) |a <|EndOfText|>,x.<|endoftext|>,b.c-9+1 _a_ ~x~ é,é. «a».",
    "a\x0bb\x0cc\x1cd\x1de\x85f\xa0g　h ́x é İ ΑΣ Σ <|startoftext|>'S don'T ﬁ 한글 각", "x" * 3000, "<|endof text|> <||> ''' ''s",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def unpacked(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


@pytest.mark.parametrize("kept", [50, 10_000])
def test_ids_are_those_of_the_library(tokenizer, kept):
    rng = random.Random(kept)
    marks = "abcAZ09 \t'|<>.,=éß́　"
    texts = AWKWARD + ["".join(rng.choice(marks) for _ in range(60)) for _ in range(300)] + [sentence(rng, GERMAN, 300)]
    encoder = packing.WordEncoder(tokenizer, 1, kept)
    for at in range(0, len(texts), 7):
        part = texts[at:at + 7]
        ids, counts = encoder.encode([t.encode() for t in part])
        assert counts.tolist() == [len(ids_of(tokenizer, t)) for t in part]
        assert ids.tolist() == [i for t in part for i in ids_of(tokenizer, t)]


def checked(rows, size, wanted):
    """Pieces tile the documents and the sequences, in all with less padding than one sequence."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert 0 < r["length"] <= size and len(r["ids"]) == 4 * r["length"]
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], unpacked(r["ids"])))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r["length"] for r in rows)
    assert sorted(by_sequence) == list(range(-(-total // size)))
    found = collections.Counter()
    for (doc_id, tokens), pieces in by_doc.items():
        copies = collections.defaultdict(list)
        for start, ids in pieces:
            copies[start].append(ids)
        # equal rows have equal ids, so any copy of the next piece will do
        while copies[0]:
            ids = copies[0].pop()
            while len(ids) < tokens:
                ids = ids + copies[len(ids)].pop()
            found[doc_id, tuple(ids)] += 1
        assert not any(copies.values())
    assert found == wanted


@pytest.mark.parametrize("size", [7, 64, 2048])
def test_pieces_tile_documents_and_sequences(documents, odd, tokenizer, size):
    rng = random.Random(size)
    rows = odd + [(10 + i, sentence(rng, ENGLISH, rng.choice([3, 30, 300, 40]))) for i in range(120)]
    rows += [(200, "one text of one length")] * 40 + [(300 + i, "the same text " * 9) for i in range(40)] + [(400, "long " * 9000)]
    rows += [(500 + i, t) for i, t in enumerate(AWKWARD)]
    df = documents(rows, 5)
    coded = packing.tokenise(df, PATH, 1, ["doc_id", "a.b"])
    packed = packing.pack(coded, ["doc_id", "a.b"], size=size)
    assert packed.columns == ["doc_id", "a.b", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    got = packed.collect()
    checked([r for r in got], size, collections.Counter((i, tuple(ids_of(tokenizer, t))) for i, t in rows))
    assert {r["a.b"] for r in got} == {"d"}
    full = packing.sequences(packed.select("sequence_id", "offset", "ids"))
    whole = {r["sequence_id"]: unpacked(r["ids"]) for r in full.collect()}
    for r in got:
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == unpacked(r["ids"])


def test_no_documents_and_clashing_names(documents, spark):
    coded = packing.tokenise(documents([]), PATH, 1, ["doc_id", "ids"])
    assert coded.columns == ["doc_id", "ids"] and packing.pack(coded, ["doc_id"]).count() == 0
    ids = struct.pack("<5I", 1, 2, 3, 4, 5)
    df = spark.createDataFrame([(1, ids, "s", "x"), (1, ids, "s", "x"), (None, None, "s", "x"), (3, b"", "s", "x")], "doc_id long, ids binary, start string, __part string")
    got = packing.pack(df, ["doc_id", "start", "__part"], size=4)
    assert got.columns == ["doc_id", "__part", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert sorted(r["length"] for r in got.collect()) == [1, 1, 4, 4]
    named = packing.pack(df, ["doc_id", "start"], size=4, prefix="p_")
    assert {r["start"] for r in named.collect()} == {"s"} and "p_start" in named.columns


def test_the_histogram_decides_the_work():
    plan = packing.shortest_pack_first({2048: 10**12, 1500: 10**12, 700: 3 * 10**11, 1: 10**13}, 2048)
    assert len(plan.length) < 10_000
    total = 2048 * 10**12 + 1500 * 10**12 + 700 * 3 * 10**11 + 10**13
    assert plan.sequences == -(-total // 2048)
    # the longest lie first, each at the beginning of a sequence
    assert plan.offset[plan.length == 2048].tolist() == [0]
    assert packing.shortest_pack_first({}, 16).sequences == 0
    with pytest.raises(ValueError):
        packing.shortest_pack_first({17: 1}, 16)


def test_lengths_that_fit_stay_whole():
    plan = packing.shortest_pack_first({6: 100, 4: 100, 5: 20}, 10)
    assert (plan.taken == plan.length).all()
