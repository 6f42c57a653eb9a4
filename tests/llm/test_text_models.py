"""Language, quality and the n-gram model."""

import collections
import math
import random
import re

import pytest
from llm_data import ENGLISH, GERMAN, documents, odd, sentence  # noqa: F401
from pyspark.sql import functions as F

from lakeops.llm import language, lm, quality


def test_language(documents, odd):
    rng = random.Random(3)
    train = [(i, sentence(rng, ENGLISH if i % 2 else GERMAN, 40), "en" if i % 2 else "de") for i in range(200)] + [(999, "x y z", None)]
    found = language.learn(documents(train))
    assert list(found) in (["de", "en"], ["en", "de"])
    held = [(1000 + i, sentence(rng, ENGLISH if i % 2 else GERMAN, 30)) for i in range(60)]
    held += [(2000, sentence(rng, ENGLISH, 30) + " " + sentence(rng, GERMAN, 4000))]
    df = documents(held + odd)
    got = {r["doc_id"]: r for r in language.identify(df, found, df.columns).collect() if r["doc_id"]}
    right = sum(got[i]["lang_pred"] == ("en" if (i - 1000) % 2 else "de") for i in range(1000, 1060))
    assert right >= 58 and got[2000]["lang_pred"] == "de"
    for i in (1, 2, 3, 5):
        assert got[i]["lang_pred"] == "und" and got[i]["rejected"] and got[i]["score"] == 0
    assert got[4]["lang_pred"] == got[7]["lang_pred"] and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[4]["a.b"] == "d"
    # no labels, no rows
    assert language.learn(documents([(1, "a b", None)])) == {}
    assert {r["lang_pred"] for r in language.identify(df, {}, ["doc_id"]).collect()} == {"und"}
    assert language.identify(documents([]), found, ["doc_id"]).count() == 0


def test_copies_count_once_in_a_dictionary(documents):
    shared = "all rights reserved by the owner"
    docs = [(i, f"{shared}\nown line {i} of text", "en") for i in range(20)] + [(100 + i, "copied line alone", "en") for i in range(500)]
    made = language.learn(documents(docs))["en"].decode()
    assert shared not in made and made.count("copied line alone") == 1


def test_few_long_texts_are_learned(documents):
    rng = random.Random(4)
    small = language.Settings(dictionary_bytes=4000, sample_bytes=3000)
    for seed in range(3):
        docs = [(i, f"text {seed} {i} " + sentence(rng, ENGLISH, 40_000), "en") for i in range(2)]
        docs += [(10 + i, "\n".join(f"{seed} {i} " + sentence(rng, GERMAN, 9) for _ in range(4000)), "de") for i in range(2)]
        docs += [(20, "ü" * 9000, "xx"), (21, "a b", "yy")]
        made = language.learn(documents(docs), settings=small)
        assert set(made) == {"en", "de", "xx", "yy"} and made["yy"] == b"a b" and made["xx"].decode() == "ü" * 1500
        assert 2900 < len(made["en"]) <= 3000 and 2000 < len(made["de"]) <= 3000


def test_quality(spark, documents, odd):
    rng = random.Random(5)
    def text(good):
        words = sentence(rng, ENGLISH, rng.randrange(10, 80))
        return words if good else " ".join(w.upper() + "!!" for w in words.split())
    docs = [(i, text(i % 4)) for i in range(800)]
    labels = spark.createDataFrame(
        [(i, int(i % 4 > 0)) for i in range(600)] + [(0, 0), (1, None), (None, 1)], "doc_id long, quality int")
    chosen = quality.sample_labels(labels, "doc_id", "quality")
    assert chosen.count() == 600
    df = documents(docs + [(1000 + (i or 0), t) for i, t in odd])
    labelled = df.join(chosen, df["doc_id"] == chosen["key"]).select("key", "text", "label")
    weights = quality.fit(labelled)
    scores = {r["doc_id"]: r["score"] for r in quality.score(df, weights, df.columns).collect()}
    assert sum((scores[i] >= 0.3) == (i % 4 > 0) for i in range(600, 800)) >= 198
    assert all(0 <= s <= 1 for s in scores.values()) and scores[1001] == scores[1002]
    assert scores[1004] == scores[1007]
    # weights do not depend on how rows are laid out, and no rows give none
    assert (quality.fit(labelled.repartition(7)) == weights).all()
    assert not quality.fit(labelled.limit(0)).any()
    assert quality.score(documents([]), weights, ["doc_id"]).count() == 0
    few = quality.sample_labels(labels, "doc_id", "quality", quality.Settings(most_rows=100)).count()
    assert 50 < few < 160


def kneser_ney(train, texts):
    words = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "")), "\0"]
    pairs, count = collections.Counter(), collections.Counter()
    for t in map(words, train):
        count.update(t)
        pairs.update(zip(["\1", *t], t))
    def discount(counts):
        n = [sum(c == j for c in counts) for j in range(5)]
        if not (n[1] and n[2] and n[3]):
            return [0, 0.5, 1.0, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        return [0] + [min(max(j - (j + 1) * y * n[j + 1] / n[j], 0), j) for j in (1, 2, 3)]
    before = collections.Counter(w for _, w in pairs)
    high, low = discount(pairs.values()), discount(before.values())
    after, total = collections.defaultdict(list), collections.Counter()
    for (u, _), c in pairs.items():
        after[u].append(min(c, 3))
        total[u] += c
    n, v = sum(count.values()), len(count)
    out = []
    for t in map(words, texts):
        score = base = 0.0
        for u, w in zip(["\1", *t], t):
            base += math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1)))
            if pairs:
                p = max(before[w] - low[min(before[w], 3)], 0) / len(pairs) + sum(low[min(c, 3)] for c in before.values()) / len(pairs) / (v + 1)
                if total[u]:
                    p = p * sum(high[c] for c in after[u]) / total[u] + max(pairs[u, w] - high[min(pairs[u, w], 3)], 0) / total[u]
                score += math.log10(p)
        out.append((len(t), sum(count[w] > 0 for w in t), base, score))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_model_equals_brute_force(documents, odd, monkeypatch, small):
    if small:  # several files, a frequent word over several ranges
        for name, n in (("RANGE_TOKENS", 90), ("SHARD_WORDS", 40), ("BLOCK_TOKENS", 60)):
            monkeypatch.setattr(lm, name, n)
    rng = random.Random(7)
    train = [(i, "the " * (i % 5) + sentence(rng, ENGLISH, rng.randrange(30))) for i in range(80)] + odd
    held = [(100 + i, sentence(rng, GERMAN if i % 3 else ENGLISH, 12)) for i in range(20)] + odd
    model = lm.fit(documents(train))
    got = sorted((tuple(r) for r in lm.score(documents(held), model, ["text"]).collect()), key=repr)
    texts = [t for _, t in held]
    wanted = sorted(((t, *x) for t, x in zip(texts, kneser_ney([t for _, t in train], texts))), key=repr)
    for a, b in zip(got, wanted):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9)


def test_probabilities_sum_to_one(documents):
    train = ["a b a c", "a b", "b c a", "c", ""]
    model = lm.fit(documents(list(enumerate(train))))
    vocabulary = ["a", "b", "c", "never"]
    for context in ("a", "b", "never"):
        # of a word after the context, and of the end after it
        texts = [f"{context} {w}" for w in vocabulary]
        scorer = lm.Scorer(model)
        first, second, _, _ = lm._numbered(scorer.words, [t.encode() for t in [context, *texts]])
        whole = scorer.score([t.encode() for t in [context, *texts]])[3]
        ends = scorer.score([w.encode() for w in [context, *vocabulary]])[3]
        alone = ends[0]
        after = 10 ** alone
        total = 0.0
        for w, s, e in zip(vocabulary, whole[1:], ends[1:]):
            # log p(context w end) = log p(context) + log p(w | context) + log p(end | w)
            start_w = 10 ** e
            total += 10 ** s / start_w * _first(scorer, w) / _first(scorer, context)
        assert total + after / _first(scorer, context) == pytest.approx(1.0, rel=1e-6)


def _first(scorer, word):
    """The probability of a word at the start: that of its text over that of the end after it."""
    import numpy as np
    m = scorer.m
    first, second, seen, _ = lm._numbered(scorer.words, [word.encode()])
    ids = np.array([second[0]])
    p = scorer._lowest(ids)[0]
    total = scorer._starts()
    follow = scorer._followers(np.array([m.words]))[:, 0]
    p *= float(np.array(m.discounts) @ follow) / total
    if second[0] >= 0:
        c = scorer._times(np.array([m.words * m.base + second[0]], np.uint64))[0]
        p += max(c - [0.0, *m.discounts][int(min(c, 3))], 0) / total
    return p


def test_model_of_nothing(documents):
    model = lm.fit(documents([]))
    got = lm.score(documents([(1, "a b")]), model, ["doc_id"]).first()
    assert tuple(got)[:3] == (1, 3, 0) and got["score"] == 0
    assert lm.score(documents([]), model, ["doc_id"]).count() == 0


def test_perplexity(spark):
    df = spark.createDataFrame([(-3.0, 3)], "score double, n_tokens long")
    assert df.select(lm.perplexity(F.col("score"), F.col("n_tokens"))).first()[0] == pytest.approx(10.0)
