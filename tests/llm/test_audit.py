"""Filters in every order, and the sketch that clears texts which occur once."""

import itertools
import random
import re

import numpy as np
import pytest
from llm_data import ENGLISH, GERMAN, sentence
from pyspark.sql import functions as F

from lakeops.llm import audit, queries


def brute(docs, labels):
    """A row for each part, order and step, by running every order over every document."""
    seen, fails = {}, []
    for i, text, source in docs:
        text = text or ""
        if i is not None:
            seen[text] = min(i, seen.get(text, i))
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and seen[text] < i,
        }
        good = any(l == i and i is not None and q == 1 for l, q, _ in labels)
        toxic = any(l == i and i is not None and t == 1 for l, _, t in labels)
        fails.append((source or "", {f for f, x in failed.items() if x}, good, toxic))
    out = []
    for part in {f[0] for f in fails}:
        rows = [f[1:] for f in fails if f[0] == part]
        steps = {}
        for order in itertools.permutations("ABCDE"):
            left = rows
            for at, f in enumerate(order):
                removed = [r for r in left if f in r[0]]
                before = set(order[:at])
                kept = [r for r in left if f not in r[0]]
                steps["".join(order), at + 1] = [
                    len(kept), len(removed), sum(f in r[0] and bool(r[0] & before) for r in rows), sum(r[0] == {f} for r in rows),
                    sum(r[1] for r in removed), sum(r[2] for r in removed),
                ]
                left = kept
        for (order, step), row in steps.items():
            f = order[step - 1]
            out.append((part, order, step, *row, sum(v[1] for (o, s), v in steps.items() if o[s - 1] == f)))
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def written(spark, folder, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("part", F.lit("own")).withColumn("mask", F.lit("x")) \
        .repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_every_order_equals_running_the_filters(spark, tmp_path):
    rng = random.Random(3)
    docs = []
    for i in range(120):
        text = sentence(rng, rng.choice([ENGLISH, GERMAN]), rng.choice([10, 60, 90]))
        text += rng.choice(["", "", " #", " $ AND SHOUTING " * 9, " 50% | "])
        docs.append((i, text, rng.choice(["a", "b", "b", "", None])))
    docs += [(200 + i, docs[i % 5][1], "c") for i in range(40)]  # copies of a few
    docs += [(300, None, "a"), (301, "", None), (302, " \n", "a"), (303, "", "b"), (None, docs[3][1], "a"), (None, docs[3][1], None), (None, None, "a")]
    docs += [(304, "twice " * 60, "a"), (304, "twice " * 60, "a"), (304, "other text of that id", "a"), (305, "x" * 20000 + " y" * 9000, "b"), (-7, docs[0][1], "c")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, 1, None])) for i in range(0, 240, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1), (999, 1, 1)]
    got = queries.QUERIES["op12_filter_audit"](spark, written(spark, tmp_path, docs, labels))
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == brute(docs, labels)


def test_no_documents(spark, tmp_path):
    got = queries.QUERIES["op12_filter_audit"](spark, written(spark, tmp_path, [], []))
    assert sorted(got.columns) == sorted(COLUMNS) and got.count() == 0


def test_no_labels(spark, tmp_path):
    got = queries.QUERIES["op12_filter_audit"](spark, written(spark, tmp_path, [(1, "a b", "s")], []))
    # a text of two words fails the first filter alone, which stands in each of the 120 orders
    assert got.count() == 600 and got.agg(F.sum("good_lost"), F.sum("shapley")).first()[:] == (0, 120 * 120)


@pytest.mark.parametrize("cells", [512, 4096])
def test_repeats_are_never_cleared_and_most_others_are(spark, cells):
    once = [(i,) for i in range(4000)]
    twice = [(10_000 + i % 500,) for i in range(1000)] + [(77_777,)] * 3000
    frame = spark.createDataFrame(once + twice, "n long").repartition(7).select(F.xxhash64("n").alias("hash"), "n")
    sketch = audit.count_cells(frame.select("hash"), 8000, cells)
    assert sketch.segments == -(-8000 * 16 // cells)
    rows = frame.distinct().toPandas()
    flagged = sketch.repeats(rows["hash"].to_numpy())
    several = rows["n"].to_numpy() >= 10_000
    assert flagged[several].all()
    assert flagged[~several].mean() < 0.1


def test_cells_lie_in_one_block():
    at = audit._cells(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64), 8192)
    assert at.min() >= 0 and at.max() < 8192 and (at // audit.BLOCK_CELLS == at[:, :1] // audit.BLOCK_CELLS).all()
