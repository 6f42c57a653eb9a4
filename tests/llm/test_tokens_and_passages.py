"""Byte-pair encoding, benchmark windows and personal data."""

import collections
import math
import random
import re
import struct
import time

import public_tokenizers
import pytest
import tiktoken
from llm_data import ENGLISH, documents, odd, sentence  # noqa: F401
from pyspark.sql import functions as F

from lakeops.llm import bpe, decontaminate, pii


@pytest.fixture(scope="module")
def vocabulary():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.serialise(ranks, public_tokenizers.PATTERN), ranks


TEXTS = [
    "Hello world, it's 12345 o'clock\n\n  \t x", "a" * 3000, " " * 500 + "end", "汉字漢字 émigré Ünï ​́ 😀👩‍👩‍👧 <|endoftext|> </s>",
    "\x00\x01▁▁ low", "'S 'll I'LL don't", "0" * 999 + ".5", " 　 wide spaces   line",
]


def test_encodes_as_the_reference_library(documents, odd, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 500)
    monkeypatch.setattr(bpe, "STEP", 200)
    model, ranks = vocabulary
    rng = random.Random(2)
    texts = TEXTS + ["".join(chr(rng.choice([rng.randrange(1, 128), rng.randrange(128, 0x3000)])) for _ in range(200)) for _ in range(40)]
    texts.append(sentence(rng, ENGLISH, 2000))
    df = documents([(100 + i, t) for i, t in enumerate(texts)] + odd)
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(df, model, ["doc_id", "text", "a.b"])
    for r in bpe.decode(coded, model, coded.columns).collect():
        wanted = encoding.encode_ordinary(r["text"] or "")
        assert list(struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"])) == wanted
        assert bytes(r["decoded"]) == (r["text"] or "").encode() and r["a.b"] == "d"
    assert bpe.encode(documents([]), model, ["doc_id"]).count() == 0


def test_ranks_with_gaps_and_missing_bytes(documents):
    ranks = {bytes([b]): 2 * b for b in range(256)} | {b"ab": 1000, b"abc": 1500, b"bc": 900}
    model = bpe.serialise(ranks, r"\S+|\s+")
    ids = bpe.Encoder(model).encode("abc ab")
    encoding = tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == encoding.encode_ordinary("abc ab")
    with pytest.raises(ValueError):
        bpe.Encoder(bpe.serialise({b"a": 0, b"b": 1}, r"\S+")).encode("ax")


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def passages(docs, items, width):
    windows = {}
    for name, text in items:
        w = words_of(text)
        m = min(width, len(w))
        if name is not None and m:
            for i in range(len(w) - m + 1):
                windows.setdefault(tuple(w[i:i + m]), set()).add(str(name))
    out = []
    for key, text in docs:
        w, hit, found = words_of(text), set(), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if names := windows.get(tuple(w[i:i + m])):
                    hit.update(range(i, i + m))
                    found |= names
        out.append((key, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [1 << 20, 60])
def test_windows_equal_brute_force(spark, documents, odd, monkeypatch, chunk):
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(decontaminate, "LANE", 16)
    if chunk < 100:
        monkeypatch.setattr(decontaminate, "PIECE_WORDS", 3)
    rng = random.Random(4)
    few = ENGLISH[:4]
    items = [(i, sentence(rng, few if i % 2 else ENGLISH, rng.randrange(1, 16))) for i in range(30)]
    items += [(3, "ONE-two three"), (50, "one two three"), (51, None), (52, "..."), (None, "no name here"), (50, "one two three"), (53, "漢字 é")]
    docs = [(100 + i, sentence(rng, few, rng.randrange(120))) for i in range(60)] + odd
    docs += [(300, "x " + items[0][1] + " y"), (301, "a one,TWO three b"), (302, "so no\nname here"), (303, "漢字;É é 漢字!é"), (304, sentence(rng, ENGLISH, 4000) + " one two three")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("extra", F.lit(1))
    df = documents(docs)
    got = []
    for r in decontaminate.find_passages(df, benchmark, df.columns, width=5).collect():
        runs = r["hits"]
        got.append((r["doc_id"], r["n_words"], [i for a, b in zip(runs[::2], runs[1::2]) for i in range(a, b)], r["items"]))
        assert (r["doc_id"] is None or r["text"] == dict(docs)[r["doc_id"]]) and r["a.b"] == "d"
    assert sorted(got, key=repr) == passages(docs, items, 5)
    assert decontaminate.find_passages(documents([]), benchmark, ["doc_id"]).count() == 0
    none = decontaminate.find_passages(df, benchmark.limit(0), ["doc_id"])
    assert none.where(F.size("hits") > 0).count() == 0 and none.count() == len(docs)


def test_block_bounds_do_not_join_documents(spark, documents):
    benchmark = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    df = documents([(i, t) for i, t in enumerate(["x alpha beta", "gamma y", "alpha", "beta gamma", "alpha beta gamma"])], parts=1)
    got = {r["doc_id"]: r["hits"] for r in decontaminate.find_passages(df, benchmark, ["doc_id"]).collect()}
    assert got == {0: [], 1: [], 2: [], 3: [], 4: [0, 3]}


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    digits = lambda v: re.sub("[^0-9]", "", v)
    good = {
        "email": lambda v: True, "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
        "card": lambda v: 16 <= len(digits(v)) <= 19 and pii.luhn(digits(v)), "phone": lambda v: 8 <= len(digits(v)) <= 15,
    }
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if good[k](m.group())]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(6)
    alphabets = ["ab@.-+1 9", "0123456789. ", "0123456789 -+()", "a@b.c@d-e.f g", "4929 -1", "é@a.b1+"]
    texts = ["".join(rng.choice(a) for _ in range(rng.randrange(90))) for a in alphabets for _ in range(700)]
    texts += ["4111 1111 1111 1111", "x 4111-1111-1111-1111-5", "+1 (989) 555-3296", "1.2.3.4.5.6.7.8.9", "256.1.1.1 0000255.1.1.1", "a@b a@b.c@d.e", "ſ@é.c"]
    for t in texts:
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == plain_spans(t), t


def test_long_texts_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+" + "1(" * 150_000, "@" * 300_000, "1 " * 150_000):
        pii.base_spans(t)


def test_terms_that_disclose(documents, odd):
    rng = random.Random(8)
    docs = [(i, sentence(rng, ENGLISH, 30)) for i in range(300)]
    # a name that stands only near one address, in different contexts
    docs += [(1000 + i, f"{sentence(rng, ENGLISH, 12)} Zorblax at zorb@x.example.com {sentence(rng, ENGLISH, 12)}") for i in range(6)]
    # copies of one passage are one piece of evidence
    docs += [(2000 + i, "Quuxly wrote copy@x.example.com once") for i in range(8)]
    # an address that a part of the rows holds among words that are everywhere
    docs += [(3000 + i, f"{sentence(rng, ENGLISH, 12)} hot@x.example.com {sentence(rng, ENGLISH, 12)}") for i in range(150)]
    df = documents(docs + odd)
    found = {r["doc_id"]: r for r in pii.find_personal(df, df.columns).collect() if r["doc_id"] is not None}
    for i, t in docs:
        r = found[i]
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == plain_spans(t)
        assert {t[s["start"]:s["end"]] for s in r["terms"]} == ({"Zorblax"} if 1000 <= i < 2000 else set()), t
    clean = {r["doc_id"]: r for r in pii.sanitise(df).collect()}
    assert pii.sanitise(df).columns == df.columns and clean[1]["text"] is None and clean[2]["text"] == "" and clean[4]["a.b"] == "d"
    assert "Zorblax" not in clean[1000]["text"] and "[email]" in clean[1000]["text"]
    assert clean[2000]["text"] == "Quuxly wrote [email] once" and clean[0]["text"] == dict(docs)[0]
    assert pii.find_personal(documents([]), ["doc_id"]).count() == 0


def test_entities_of_one_document_disclose(documents):
    rng = random.Random(9)
    near = lambda name, i: f"{sentence(rng, ENGLISH, 9)} {name} your p{i}@x.example.com {sentence(rng, ENGLISH, 9)}"
    names = ["Zorblax", "Li", "Ng", "王芳"]
    docs = [(i, sentence(rng, ENGLISH, 30)) for i in range(600)] + [(1000 + i, near(n, i)) for i, n in enumerate(names)]
    docs += [(2000 + i, near("Twice", 99)) for i in range(2)]
    found = {r["doc_id"]: r["terms"] for r in pii.find_personal(documents(docs), ["doc_id"]).collect()}
    told = {i: {t[s["start"]:s["end"]] for s in found[i]} for i, t in docs}
    assert told == {i: set() for i in range(600)} | {1000 + i: {n} for i, n in enumerate(names)} | {2000: {"Twice"}, 2001: {"Twice"}}


def test_terms_are_marked_in_whole_texts(documents):
    rng = random.Random(10)
    docs = [(i, sentence(rng, ENGLISH, 30)) for i in range(600)]
    docs += [(1000 + i, f"{sentence(rng, ENGLISH, 9)} Zorblax zorb@x.example.com {sentence(rng, ENGLISH, 9)}") for i in range(3)]
    # far from the address in a long text, and in a text without it, both behind letters of two bytes
    docs += [(2000, f"Ünal Zorblax, {sentence(rng, ENGLISH, 2000)} zorb@x.example.com"), (2001, f"é zorblax {sentence(rng, ENGLISH, 9)}")]
    # a name that is in the heading of long texts more often than it is near the address
    far = [f"Quuxly {sentence(rng, ENGLISH, 300)} quux@x.example.com" for _ in range(9)]
    docs += [(3000 + i, t) for i, t in enumerate([*far, f"{sentence(rng, ENGLISH, 9)} Quuxly quux@x.example.com"])]
    found = {r["doc_id"]: r["terms"] for r in pii.find_personal(documents(docs), ["doc_id"]).collect()}
    told = {i: [t[s["start"]:s["end"]] for s in found[i]] for i, t in docs}
    names = {1000: ["Zorblax"], 1001: ["Zorblax"], 1002: ["Zorblax"], 2000: ["Zorblax"], 2001: ["zorblax"]}
    assert {i: x for i, x in told.items() if x and i < 3000} == names
    # one context of an entity in ten texts is too little evidence
    assert not any(told[i] for i in range(3000, 3010))
    more = docs + [(4000 + i, f"{sentence(rng, ENGLISH, 9)} Quuxly quux@x.example.com") for i in range(2)]
    found = {r["doc_id"]: r["terms"] for r in pii.find_personal(documents(more), ["doc_id"]).collect()}
    assert all(t[s["start"]:s["end"]] == "Quuxly" and s["share"] > 0.99 for i, t in more if i >= 3000 for s in found[i])
    assert all(len(found[i]) == 1 for i, _ in more if i >= 3000)


def plain_terms(docs, s=pii.Settings()):
    """The terms of each text, by counting everything in plain Python."""
    lower = lambda w: "".join(c.lower() if c.isascii() else c for c in w)
    spans = {i: plain_spans(t) for i, t in docs}
    words = {i: [(m.start(), m.end(), lower(m.group())) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t)] for i, t in docs}
    contexts, holds = collections.defaultdict(set), collections.defaultdict(set)
    for i, text in docs:
        for kind, a, b in spans[i]:
            value = text[a:b]
            entity = (kind, value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value))
            holds[entity].add(i)
            near = []
            for lo, hi in ((a - s.window, a), (b, b + s.window)):
                near += [(x, y, w) for x, y, w in words[i] if lo <= x and y <= hi and not any(x < q and p < y for _, p, q in spans[i])]
            near = [w for x, y, w in near if y - x >= s.shortest or not text[x:y].islower()]
            for w in near:
                contexts[entity, w].add(tuple(near))
    n, share = len(docs), collections.defaultdict(float)
    for (entity, w), seen in contexts.items():
        of_term = {i for i, _ in docs if any(w == x[2] for x in words[i])}
        both, n_term, n_entity = len(of_term & holds[entity]), len(of_term), len(holds[entity])
        p = both / n_term
        low = (p + 0.5 / n_term - math.sqrt(p * (1 - p) / n_term + 0.25 / n_term**2)) / (1 + 1 / n_term)
        if n_entity < n and low >= s.likely - 1e-9:
            trust = min(1, len(seen) / s.support)
            share[w] = max(share[w], math.log2(trust * both * n / n_term / n_entity + 1 - trust) / math.log2(n / n_entity))
    return {i: [(a, b) for a, b, w in words[i] if share[w] >= s.generalise and not any(a < q and p < b for _, p, q in spans[i])] for i, _ in docs}


def test_terms_equal_plain_counting(documents):
    rng = random.Random(12)
    names = ["Li", "Ünsal", "the"] + [f"Name{chr(97 + i)}x" for i in range(22)]
    docs = []
    for i in range(340):
        text = sentence(rng, ENGLISH, rng.choice([5, 25, 60]))
        if i % 3 == 0:
            who = rng.randrange(len(names))
            value = [f"p{who}@x.example.com", f"10.0.0.{who}", f"+1 989 555 32{10 + who}", f"p{i}@y.example"][(who + (i % 5 == 0)) % 4]
            text += f" {names[who]} {rng.choice(['at', 'near', 'Mr', ''])} {value} " + sentence(rng, ENGLISH, 12)
        if i % 17 == 0:
            text += f" {rng.choice(names)} {i}th"
        docs.append((i, text))
    found = {r["doc_id"]: [(x["start"], x["end"]) for x in r["terms"]] for r in pii.find_personal(documents(docs), ["doc_id"]).collect()}
    wanted = plain_terms(docs)
    assert found == wanted and sum(map(len, wanted.values())) > 30


def test_planted_names_are_found_and_other_words_stay(documents):
    """Rare words beside an address that clean texts hold too are left alone there."""
    rng = random.Random(13)
    rare = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(4)) for _ in range(400)]
    names = [f"Name{chr(97 + i // 26)}{chr(97 + i % 26)}son" for i in range(60)]
    docs = [(i, f"{sentence(rng, ENGLISH, 20)} {rng.choice(rare)} {sentence(rng, ENGLISH, 5)} {rng.choice(rare)}") for i in range(900)]
    docs += [(1000 + i, f"{sentence(rng, ENGLISH, 8)} {rng.choice(rare)} {n} {n.lower()}@x.example.com {rng.choice(rare)} {sentence(rng, ENGLISH, 8)}") for i, n in enumerate(names)]
    terms = {r["doc_id"]: r["terms"] for r in pii.find_personal(documents(docs), ["doc_id"]).collect()}
    assert sum(bool(terms[i]) for i in range(900)) <= 9
    assert all(any(t[x["start"]:x["end"]] == names[i - 1000] for x in terms[i]) for i, t in docs if i >= 1000)


def test_many_entities_in_one_text_take_linear_time(documents):
    text = " ".join(f"person{i} wrote m{i}@x{i % 7}.example.com and left" for i in range(50_000))
    begun = time.monotonic()
    found = pii.find_personal(documents([(1, text), (2, "other words"), (3, None)], 1), ["doc_id"]).collect()
    assert {r["doc_id"]: len(r["base"]) for r in found} == {1: 50_000, 2: 0, 3: 0}
    assert time.monotonic() - begun < 60


def test_redaction_joins_overlaps():
    base = [{"kind": "card", "start": 2, "end": 8}, {"kind": "phone", "start": 0, "end": 5}]
    assert pii.redacted("0123456789", base, [{"start": 9, "end": 10, "share": 0.8}]) == "[phone]8[term]"
    assert pii.redacted("0123456789", [], [{"start": 2, "end": 4, "share": 1.0}]) == "01456789"
