"""Each operator of this package over its whole table, by the results agreed for it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import audit, bpe, chat, decontaminate, language, lm, nearest, packing, pii, quality, similar, urls, variants
from lakeops.llm.base import QUERIES, SQL, query, table  # noqa: F401
from lakeops.llm.frames import remainder


@query("op1_quality")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labelled rows that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    chosen = quality.sample_labels(labels.where(~held_out), "doc_id", "quality")
    # at most Settings.most_rows pairs of numbers
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("key")).select("key", "text", "label")
    scored = quality.score(docs, quality.fit(labelled), ["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]


@query("op2_urls")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL."""
    return urls.judge(table(spark, folder, "pages"), URL_RULES, ["page_id"])


@query("op3_language_model")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """The log10 probability of every document under a model of those that are not held out."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 10) == 0, F.lit(False))
    model = lm.fit(docs.where(~held_out))
    return lm.score(docs, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )


@query("op4_byte_bpe")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    vocabulary = bpe.serialise(ranks, public_tokenizers.PATTERN)
    ids = bpe.encode(table(spark, folder, "documents"), vocabulary, ["doc_id"])
    return bpe.decode(ids, vocabulary, ["doc_id", "ids"]).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP5_SQL = r"""
WITH cut AS (
    SELECT *, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
    FROM (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)),
w AS (
    SELECT DISTINCT id::VARCHAR AS item, width, array_to_string(words[pos:pos + width - 1], ' ') AS words
    FROM (SELECT *, least(10, len(words)) AS width, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
          FROM cut WHERE side = 'b' AND len(words) > 0)),
f AS (
    SELECT id, pos, p.width, w.item
    FROM (SELECT c.id, l.width, c.words, unnest(range(1, len(c.words) - l.width + 2)) AS pos
          FROM cut c JOIN (SELECT DISTINCT width FROM w) l ON c.side = 'd' AND len(c.words) >= l.width) p
    JOIN w ON w.width = p.width AND w.words = array_to_string(p.words[pos:pos + p.width - 1], ' ')),
h AS (SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(pos, pos + width)) AS place FROM f) GROUP BY id),
i AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM f) GROUP BY id)
SELECT c.id AS doc_id, len(c.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
    coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.items, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM cut c LEFT JOIN h ON h.id = c.id LEFT JOIN i ON i.id = c.id WHERE c.side = 'd'
"""


@query("op5_decontaminate", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])
    # hits holds begins and ends in turn
    n_hit = F.aggregate("hits", F.lit(0), lambda s, x: x - s, lambda s: s).cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


OP6_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
    SELECT *, regexp_replace(replace(text, '\', '\\'), '([<\[])(/?INST\]|/?ROLE\]|/?s>|</?SYS>>)', '\1\\\2', 'g') AS escaped FROM c)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(length(escaped) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 17 ELSE 23 + length(role) END))::BIGINT
        AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op6_chat", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation and one of control strings, formatted and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    written = chat.formatted(chat.canonical(rows.unionByName(added)))
    return written.select(
        "conv_id", "formatted", "mask", chat.read_back(F.col("formatted")).alias("read"),
    ).select(
        "conv_id", "formatted", F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256)
        .alias("turns_sha256"),
        chat.under_mask(F.col("formatted"), F.col("mask")).alias("loss"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op7_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    dictionaries = language.learn(docs.where(~held_out))
    return language.identify(docs, dictionaries, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected",
    )


@query("op8_personal_data")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: what the patterns find, and terms that disclose it."""
    found = pii.find_personal(table(spark, folder, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    terms = F.transform("terms", lambda x: F.struct(F.lit(pii.TERM).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    base = pii.joined(F.col("base"))
    return found.select(
        "doc_id", *[count(kind) for kind in pii.KINDS], F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.when(base != "", base), F.when(F.size("terms") > 0, pii.joined(terms))).alias("spans"),
    )


OP9_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op9_top_k", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """The five best vectors for every vector whose id is divisible by 50."""
    vectors = table(spark, folder, "embeddings")
    return nearest.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


OP10_SQL = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(words[pos:pos + least(5, len(words)) - 1], ' ') AS shingle
    FROM (SELECT *, unnest(range(1, len(words) - least(5, len(words)) + 2)) AS pos FROM cut WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""


@query("op10_jaccard", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near copies of every document."""
    return similar.link(table(spark, folder, "documents"))


@query("op11_spelling_variants")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents, some of them with a letter left out, under their most frequent forms."""
    found = F.regexp_extract_all(F.col("text"), F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))
    runs = table(spark, folder, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    # only A-Z are lower-cased; most runs have no other letters
    ascii_only = F.length("run") == F.octet_length("run")
    small = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = runs.select("id", F.when(ascii_only, F.lower("run")).otherwise(small).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= 5).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    return variants.group(counts)


OP12_SQL = r"""
WITH t AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
m AS (
    SELECT doc_id, part,
        CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
    FROM t),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM f a JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f) JOIN f d ON d.f NOT IN (a.f, b.f, c.f)
    JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
s AS (
    SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
    FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
x AS (SELECT *, (mask & own) <> 0 AS fails, (mask & before) <> 0 AS earlier FROM c, s),
r AS (
    SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (fails AND NOT earlier), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (fails AND earlier), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (fails AND NOT earlier), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (fails AND NOT earlier), 0)::BIGINT AS toxic_lost
    FROM x GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


@query("op12_filter_audit", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove from each source, in every order."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    n_words = F.size(words)
    fails = [
        n_words < 50,
        100 * F.size(F.array_distinct(words)) < 65 * n_words,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    mask = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0))
    rows = audit.later_copies(docs, "doc_id", text, {"part": F.coalesce("source", F.lit(""))}, mask)
    rows = rows.withColumn("mask", F.col("mask") + F.when(F.col("later"), 16).otherwise(0))
    labels = labels.withColumnRenamed("quality", "good")
    return audit.order_table(audit.mask_counts(rows, labels, "doc_id", ["good", "toxic"]), "ABCDE", ["good", "toxic"])


@query("op13_packing")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document, and its place in the sequences of 2048 ids."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    coded = packing.tokenise(table(spark, folder, "documents"), tokenizer, 1, ["doc_id"])
    return packing.pack(coded, ["doc_id"]).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )
