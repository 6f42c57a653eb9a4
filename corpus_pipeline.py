"""From raw documents to token ids: the stages, in order, and the whole run.

Each stage takes what the one before has kept. All but the last return the columns
of ``documents`` as they came.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.durable import materialize
from lakeops.llm import bpe, decontaminate, language, pii, similar
from lakeops.llm.base import table
from lakeops.llm.frames import free_prefix, named

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is told clearly, learned from their own labels.

    Texts that are null or have no letter go, and those for which two languages come
    out alike.
    """
    p = free_prefix(docs)
    told = language.identify(docs, language.learn(docs), docs.columns, prefix=p)
    return told.where(~F.col(f"{p}rejected")).select(*[named(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    return similar.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of a test item."""
    p = free_prefix(docs)
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"), docs.columns, prefix=p)
    return found.where(F.size(f"{p}hits") == 0).select(*[named(c) for c in docs.columns])


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data taken out of their texts and ``n_chars`` as it then is."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the text's ids packed as 32-bit integers, how many, and whether they decode to the text."""
    vocabulary = bpe.serialise(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    rows = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("of_text"), "text")
    ids = bpe.encode(rows, vocabulary, ["doc_id", "of_text"])
    return bpe.decode(ids, vocabulary, ["doc_id", "of_text", "ids"]).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.sha2("decoded", 256) == F.col("of_text")).alias("decodes"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near copies", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("tokens", token_ids),
]

#: compression sizes and token merges have no counterpart in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
