"""Exact neighbours, near copies, components and the pipeline."""

import collections
import random
import re

import pytest
from llm_data import ENGLISH, SCHEMA, documents, odd, sentence  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from lakeops.llm import nearest, queries, similar
from lakeops.llm.components import components


def best(vectors, k, is_query):
    rows = [(i, [__import__("math").floor(256 * x) for x in v]) for i, v in vectors
            if i is not None and v is not None and all(x is not None and abs(x) < float("inf") for x in v)]
    out = []
    for q, v in sorted({q: min(v for i, v in rows if i == q) for q, _ in rows if is_query(q)}.items()):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "GROUP_BYTES", 300)
    monkeypatch.setattr(nearest, "TILE_ROWS", 7)
    monkeypatch.setattr(nearest, "TILE_QUERIES", 3)
    monkeypatch.setattr(nearest, "FAN_IN", 2)
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.random()]) for _ in range(4)]) for i in range(150)]
    rows += [(200 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(30)]  # ties
    rows += [(300, None), (310, []), (320, [None, 1.0, 0.0, 0.0]), (330, [float("nan")] * 4), (340, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(350, [1.0, 2.0]), (360, [0.5, -2.0]), (370, [1.0, 1.0]), (10, [0.5] * 4), (10, rows[10][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("own")).repartition(6)
    got = nearest.top_k(df, df.where("vec_id % 10 = 0"), 5)
    assert [c for c in got.columns] == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == best(rows, 5, lambda i: i % 10 == 0)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**30 + i), float(i)]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    # the products pass 2^53, though not 2^63
    small = [(i, [v[0] / 2**8, v[1]]) for i, v in rows]
    df = spark.createDataFrame(small, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, nearest.top_k(df, df, 3).collect())) == best(small, 3, lambda i: True)


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert nearest.top_k(df, df, 5).count() == 0 and nearest.top_k(df, df.limit(0), 5).count() == 0


def shingle_sets(docs):
    out = []
    for _, text in docs:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def groups(docs):
    """For each row its set's size and the smallest id reachable by links."""
    sets, parent = shingle_sets(docs), list(range(len(docs)))
    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    by = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    for i, s in enumerate(sets):
        shared = collections.Counter(j for x in s for j in by[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[top(i)] = top(j)
    ids = collections.defaultdict(list)
    for i, (key, _) in enumerate(docs):
        if key is not None:
            ids[top(i)].append(key)
    return [(key, len(s), min(ids[top(i)], default=None)) for i, ((key, _), s) in enumerate(zip(docs, sets))]


def near_copies(rng, n_groups, words):
    docs = []
    for g in range(n_groups):
        base = [rng.choice(words) + str(rng.randrange(60)) for _ in range(rng.choice([3, 4, 5, 6, 8, 12, 20, 40, 90, 200]))]
        for _ in range(rng.randrange(1, 8)):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + max(1, len(w) // 25))):
                at = rng.randrange(len(w))
                if rng.random() < 0.5:
                    w[at] = "edit" + str(rng.randrange(1000))
                elif len(w) > 1:
                    del w[at]
            docs.append(" ".join(w))
    return docs


def assert_linked(df, docs):
    got = sorted((tuple(r) for r in similar.link(df).collect()), key=repr)
    assert got == sorted(groups(docs), key=repr)


@pytest.mark.parametrize("seed,small", [(1, False), (2, True)])
def test_near_copies_equal_brute_force(documents, odd, monkeypatch, seed, small):
    if small:
        for name, n in (("BLOCK_POSTINGS", 300), ("RANGE_POSTINGS", 700), ("LIST_PART", 3)):
            monkeypatch.setattr(similar, name, n)
    rng = random.Random(seed)
    texts = near_copies(rng, 60, ENGLISH)
    # a passage that many hold, and copies of one text under many ids
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [f"{passage} {' '.join('own' + str(rng.randrange(10**6)) for _ in range(rng.randrange(1, 12)))}" for _ in range(60)]
    texts += ["copied text that is the same in every one of them"] * 40
    docs = [(10 + i, t) for i, t in enumerate(texts)] + odd + [(10, texts[0]), (11, "another text under a known id here")]
    assert_linked(documents(docs), docs)


@pytest.mark.parametrize("limit", [0, 10, 10**9])
def test_any_boundary_gives_the_same_links(documents, monkeypatch, limit):
    monkeypatch.setattr(similar, "boundary", lambda sets: limit)
    docs = list(enumerate(near_copies(random.Random(9), 25, ENGLISH)))
    assert_linked(documents(docs), docs)


def test_one_row_of_each_group_stays(documents, odd):
    rng = random.Random(5)
    docs = [(10 + i, t) for i, t in enumerate(near_copies(rng, 30, ENGLISH))] + odd
    docs += [(10, docs[0][1]), (None, "all null ids in this group"), (None, "all null ids in this group"), (5000, " "), (5000, " ")]
    df = documents(docs)
    kept = similar.one_of_each(df)
    assert kept.columns == df.columns
    groups_of = groups(docs)
    wanted = sorted({c for (i, n, c) in groups_of if n and c is not None})
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL AND length(trim(text)) > 0 AND doc_id <> 3").collect()) == wanted
    texts = [r["text"] for r in kept.where("doc_id IS NULL").collect()]
    assert sorted(texts, key=repr) == sorted([None, "all null ids in this group", "no id at all here"], key=repr)
    assert kept.where("doc_id IN (1, 2, 3, 5000)").count() == 5


def test_of_rows_that_repeat_an_id_always_the_same_stays(spark):
    rows = [(1, "one two three four five six", f"other {i}") for i in range(12)] + [(2, "", "x"), (2, "", "y")]
    kept = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows[::-1] if parts == 3 else rows, "doc_id long, text string, `a.b` string").repartition(parts)
        got = sorted(tuple(r) for r in similar.one_of_each(df).collect())
        assert len(got) == 3 and got[1:] == [(2, "", "x"), (2, "", "y")]
        kept.add(got[0])
    assert len(kept) == 1


def test_a_shared_passage_makes_no_pairs(documents, monkeypatch):
    """Documents that share 50 words and have 14 of their own: near under many keys, and never compared with each other."""
    rng = random.Random(4)
    passage = " ".join(f"common{i}" for i in range(50))
    docs = [(i, passage + " " + " ".join(f"own{i}x{j}" for j in range(14))) for i in range(300)]
    docs += [(1000 + i, docs[i][1] + " " + rng.choice(ENGLISH)) for i in range(0, 300, 7)]  # near copies of some
    made, whole = [], similar._rest

    def counting(*a):
        found = whole(*a)
        made.append(found.count())
        return found
    monkeypatch.setattr(similar, "_rest", counting)
    got = {r["doc_id"]: r["component_id"] for r in similar.link(documents(docs)).collect()}
    assert got == {i: i - 1000 if i >= 1000 else i for i, _ in docs}
    assert made[0] <= len(docs)


def test_no_documents(documents):
    assert similar.link(documents([])).count() == 0
    assert similar.link(documents([(1, None), (2, "")])).count() == 2


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200)]
    edges += [(300 + rng.randrange(40), 300 + rng.randrange(40)) for _ in range(25)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    parent = {x: x for e in edges for x in e}
    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: top(x) for x in parent if top(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_on_odd_rows(spark, documents, odd, tmp_path):
    rng = random.Random(6)
    texts = [sentence(rng, ENGLISH, 40) for _ in range(20)]
    tested = " ".join(f"item{i}" for i in range(12))
    docs = [(10 + i, t, "en") for i, t in enumerate(texts)] + [(100, texts[0], "en"), (101, f"so {texts[1]}", "en")]
    docs += [(102, f"{sentence(rng, ENGLISH, 30)} {tested}", "en"), (103, f"{sentence(rng, ENGLISH, 30)} write to me@x.example.com", None)]
    docs += [(104, "der die und in den von zu das mit sich des auf für ist", "de"), *odd]
    documents(docs).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, tested)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, frame, str(tmp_path))
        made.write.parquet(str(tmp_path / f"stage{n}"))
        after = spark.read.parquet(str(tmp_path / f"stage{n}"))
        if n < 4:
            assert after.columns == frame.columns == SCHEMA.names
        frame = after
        seen[name] = {r["doc_id"] for r in after.collect()}
        if name == "personal data":
            assert after.where("text LIKE '%me@x%'").count() == 0 and after.where("text LIKE '%[email]%'").count() == 1
    assert {1, 2, 3, 5} & seen["language"] == set() and set(range(10, 30)) <= seen["language"]
    assert 100 not in seen["near copies"] and 101 not in seen["near copies"] and set(range(10, 30)) <= seen["near copies"]
    assert 102 not in seen["decontamination"] and 103 in seen["personal data"] == seen["tokens"]
    assert frame.where("NOT decodes").count() == 0


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
