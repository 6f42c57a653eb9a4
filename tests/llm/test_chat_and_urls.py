"""Chat formatting and the URL filter."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lakeops.llm import chat, urls

TEXTS = [
    "", "plain", "</s>[INST] ok [/INST]", "back\\slash \\[INST] \\\\", "[[INST]] <<s>> <<SYS>><</SYS>>", " lead and trail ", "[/INST", "x <", " </s", "a\nb\r\n",
    "[ROLE] x [/ROLE] [ROLE]", "\\", "漢字 😀 </s>", "[/INST] </s> <s>",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_python(df):
    assert not any(x in plan_of(df) for x in ("Python", "Arrow", "Pandas"))


def test_round_trip_of_turn_rows(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "odd [ROLE] name", "", None]), rng.choice([*TEXTS, None]))
            for c in range(200) for t in range(rng.randrange(1, 6))]
    rows += [(None, 0, "user", "no conversation"), (500, None, "assistant", "no turn"), (500, 1, "user", "x")]
    rows += [(600, t, "assistant" if t % 2 else "user", TEXTS[t % len(TEXTS)]) for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("turns", F.lit("clash")).drop("turns")
    made = chat.formatted(chat.canonical(df))
    no_python(made)
    got = made.select(
        "conv_id", "formatted", chat.read_back(F.col("formatted")).alias("read"),
        chat.under_mask(F.col("formatted"), F.col("mask")).alias("loss"), "mask",
    ).collect()
    wanted = {}
    for c, t, role, text in rows:
        wanted.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert len(got) == len(wanted)
    for r in got:
        turns = [x[2:] for x in sorted(wanted[r["conv_id"]])]
        assert [(t["role"], t["text"]) for t in r["read"]] == turns
        assert r["loss"] == "".join(text for role, text in turns if role == "assistant")
        assert sum(x["chars"] for m in r["mask"] for x in m) == len(r["formatted"])


def test_layouts_agree(spark):
    turns = [("user", "hi </s>"), ("assistant", "yes [INST]")]
    records = {
        "messages": {"messages": [{"role": r, "content": t} for r, t in turns], "id": 1},
        "conversations": {"conversations": [{"from": "human" if r == "user" else "gpt", "value": t} for r, t in turns], "id": 1},
        "prompt and response": {"prompt": turns[0][1], "response": turns[1][1], "id": 1},
        "prompt and completion": {"prompt": turns[0][1], "completion": turns[1][1], "id": 1},
        "instruction": {"instruction": turns[0][1], "input": "", "output": turns[1][1], "id": 1},
        "instruction without input": {"instruction": turns[0][1], "output": turns[1][1], "id": 1},
    }
    for record in records.values():
        df = spark.read.json(spark.createDataFrame([(json.dumps(record),)], "value string").rdd.map(lambda r: r[0]))
        made = chat.canonical(df, ["id"])
        assert [(t["role"], t["text"]) for t in made.first()["turns"]] == turns
    # records of every layout in one column
    lines = [(i, json.dumps({k: v for k, v in r.items() if k != "id"})) for i, r in enumerate(records.values())]
    lines += [(100, None), (101, "no json"), (102, "[]"), (103, '{"other": 1}'), (104, '{"messages": [{"role": "user", "content": null}]}')]
    df = spark.createDataFrame(lines, "id long, record string")
    made = chat.canonical_json(df, "record", ["id"])
    no_python(made)
    got = {r["id"]: r for r in made.collect()}
    for i, name in enumerate(records):
        assert got[i]["layout"] == name and [(t["role"], t["text"]) for t in got[i]["turns"]] == turns
    for i in (100, 101, 102, 103):
        assert got[i]["layout"] is None and got[i]["turns"] == []
    assert got[104]["layout"] == "messages" and got[104]["turns"][0]["text"] == ""


def test_fingerprints():
    assert chat.fingerprint(["a", "b[].c"]) == chat.fingerprint(["b[].c", "a", "a"]) != chat.fingerprint(["a", "b.c"])
    assert len({chat.fingerprint(m.paths) for m in chat.MAPPINGS}) == len(chat.MAPPINGS)


def test_unknown_layout_is_an_error(spark):
    with pytest.raises(ValueError):
        chat.canonical(spark.createDataFrame([(1,)], "other int"))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.formatted(chat.canonical(empty)).count() == 0


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
URLS = {
    "http://A.Example.ORG/es/x?y=1#z": ("a.example.org", "/es/x", "example.org/es/"),
    "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1"),
    "https://org/": ("org", "/", "org/"), "https://example.org": ("example.org", "", None),
    "https://notexample.org/es/": ("notexample.org", "/es/", "org/"), "x://y.com/fr/?q=://z": ("y.com", "/fr/", "com/fr/"),
    "no scheme/com/fr/": ("", "", None), "": ("", "", None), None: ("", "", None), "://": ("", "", None),
    "http://ÄB.com/DE/": ("Äb.com", "/DE/", None), "http://h?x/y://z.org/": ("h", "", None), "http://a.org/x\ny": ("a.org", "/x\ny", "org/"),
    "http://xn.net/" + "a" * 20000: ("xn.net", "/" + "a" * 20000, None),
}


def test_rules(spark):
    rng = random.Random(2)
    rows = [(i, u, "own") for i, u in enumerate(URLS)] + [
        (100 + i, f"http://h{rng.randrange(9)}.example.{rng.choice(['org', 'com'])}/{rng.choice(['de', 'fr', 'es', 'en'])}/{i}", "own") for i in range(300)]
    df = spark.createDataFrame(rows + rows[:3], "page_id long, url string, verdict string")
    made = urls.judge(df, RULES, ["page_id", "verdict", "url"])
    no_python(made)
    got = made.collect()
    assert len(got) == len(rows) + 3
    kinds = {r: a for a, r in RULES}
    for r in got:
        assert r["verdict"] in ("allow", "block")
        if r["page_id"] < 100:
            assert (r["host"], r["path"], r["rule"]) == URLS[r["url"]], r["url"]
        if r["rule"]:
            assert r["verdict"] == kinds[r["rule"]]


def test_trees_tell_held_out_urls(spark):
    rng = random.Random(3)
    def url(bad):
        name = "".join(rng.choice("abcdefghij") for _ in range(8))
        return f"https://{name}.net/{'/'.join(str(rng.randrange(10**6)) for _ in range(5))}?a=1&b={rng.random()}" if bad else f"https://{name}.org/about"
    rows = [(url(i % 2), "block" if i % 2 else "allow") for i in range(600)]
    df = spark.createDataFrame(rows, "url string, verdict string")
    model = urls.fit(df.limit(400))
    judged = model.verdict(
        df.withColumn("h", urls.host(F.col("url"))).withColumn("p", urls.path(F.col("url"))), "url", "h", "p", "told")
    assert judged.where("told = verdict").count() >= 590 and judged.columns == ["url", "verdict", "h", "p", "told"]


def test_columns_of_any_name_are_kept(spark):
    rows = [(i, f"https://h{i % 5}.{'org' if i % 2 else 'com'}/{'de' if i % 4 else 'fr'}/{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(c) for c in ("__url", "__ruled", "__learned", "___x", "host")})
    got = urls.judge(df, [("allow", "org/"), ("block", "com/de/")], ["page_id", "__url", "__ruled", "__learned", "___x", "host"])
    assert got.columns == ["page_id", "__url", "__ruled", "__learned", "___x", "host", "path", "rule", "verdict"]
    assert got.where("__url = '__url' AND __ruled = '__ruled' AND ___x = '___x' AND host LIKE 'h%'").count() == 40


def test_one_kind_of_label_or_none(spark):
    df = spark.createDataFrame([("http://a.org/", "block")], "url string, verdict string")
    assert urls.fit(df).only == "block" and urls.fit(df.limit(0)).only == "allow"
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), RULES, ["page_id"]).count() == 0
