"""Words one edit apart and their groups."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lakeops.llm import queries, variants
from lakeops.llm.variants import Prefixes, Words


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long = sorted([a, b], key=len)
    i = 0
    while i < len(short) and short[i] == long[i]:
        i += 1
    return short[i + (len(a) == len(b)):] == long[i + 1:]


def brute(n, times=2):
    form, out = {}, []
    for w in n:
        others = [v for v in n if one_edit(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = (len(others), best if best is not None and n[best] >= times * n[w] else None)
    for w in n:
        root = w
        while form[root][1] is not None:
            root = form[root][1]
        out.append((w, form[w][1], root, n[w], form[w][0], n[form[w][1]] if form[w][1] is not None else None))
    return sorted(out)


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "ab漢😀"])
def test_pairs_equal_comparing_all_with_all(letters):
    rng = random.Random(len(letters))
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 5, 6, 7, 30]))) for _ in range(400)} | {"", "a" * 500, "a" * 501, "b" + "a" * 500})
    asked = rng.sample(words, len(words) // 2) + ["", "zz", "a" * 499]
    word, other = variants.near(Words.of(asked), Prefixes.of(Words.of(words)))
    assert sorted(zip(word.tolist(), other.tolist())) == [(i, j) for i, w in enumerate(asked) for j, v in enumerate(words) if one_edit(w, v)]
    assert len(variants.near(Words.of(asked), Prefixes.of(Words.of([])))[0]) == 0
    assert len(variants.near(Words.of([]), Prefixes.of(Words.of(words)))[0]) == 0


def test_prefixes_are_those_of_the_words():
    words = sorted(["", "a", "ab", "abc", "abd", "b", "bcd"])
    held = Prefixes.of(Words.of(words))
    assert len(held.first) == 1 + len({w[:i] for w in words for i in range(len(w) + 1)})
    assert [words[i] for i in held.word if i >= 0] == sorted(words, key=lambda w: (len(w), w))


@pytest.mark.parametrize("file_words", [20, 100_000])
def test_groups_equal_brute_force(spark, file_words):
    rng = random.Random(file_words)
    n = {"".join(rng.choice("abc") for _ in range(rng.choice([2, 3, 5, 6]))): rng.choice([1, 2, 3, 4, 8, 16, 40, 1000]) for _ in range(220)}
    # a long way up, and ties
    n |= {"x" * 9 + "y" * i: 3 * 2**i for i in range(12)} | {"tie": 5, "ties": 10, "tied": 10, "lone": 7, "": 3, "é": 6, "💡": 1}
    frame = spark.createDataFrame([*n.items(), (None, 9)], "word string, n int").withColumn("form", F.lit("own")).withColumn("root", F.lit(1))
    got = variants.group(frame.repartition(5), file_words=file_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute(n)


def test_no_words(spark):
    got = variants.group(spark.createDataFrame([], "word string, n long"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and got.count() == 0
    with pytest.raises(ValueError):
        variants.group(got, times=1)


def words_of(docs):
    n = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    stems = ["".join(rng.choice("etaoinéÀ") for _ in range(rng.choice([3, 5, 6]))) for _ in range(60)]
    docs = [(i, " ".join(rng.choice([str.upper, str.lower, str.title])(rng.choice(stems)) + rng.choice(["", ",", "×ab", " 漢", "7"]) for _ in range(60))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, " \n"), (None, docs[0][1]), (903, "letters" * 3000), (1, docs[1][1]), (1, docs[1][1])]
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("w")).withColumn("n", F.lit(1)).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_spelling_variants"](spark, str(tmp_path))
    wanted = brute(words_of(docs))
    assert sorted(map(tuple, got.collect())) == wanted and len(wanted) > 100 and any(r[1] for r in wanted)
