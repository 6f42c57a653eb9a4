"""Character statistics of words.

Words are counted first and every later step works on distinct words with their
counts, so a word that makes up a third of the text is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.durable import materialize
from lakeops.operators.ordering import add_row_index
from lakeops.operators.skew import spread_join

# Fixed value: the mark before and after a word.
END = "."


def words_of(text: Column) -> Column:
    """Lower-case words of a text: runs of letters."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """Distinct words and how often each occurs."""
    return df.select(F.explode(words_of(F.col(text))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def letters(word: Column) -> Column:
    """The characters of a word."""
    return F.split(word, "")


def characters(word: Column) -> Column:
    """The characters of a word between two end marks."""
    mark = F.array(F.lit(END))
    return F.concat(mark, letters(word), mark)


def pairs_of_words(words: DataFrame) -> DataFrame:
    """Each adjacent pair ``c1, c2`` of each word, with the word's count."""
    chars = words.withColumn("__c", characters(F.col("word")))
    pair = F.arrays_zip(
        F.slice("__c", F.lit(1), F.size("__c") - 1).alias("c1"),
        F.slice("__c", F.lit(2), F.size("__c") - 1).alias("c2"),
    )
    return chars.withColumn("__p", F.explode(pair)).select(*words.columns, "__p.c1", "__p.c2")


def pair_counts(words: DataFrame) -> DataFrame:
    """How often each pair of characters is adjacent."""
    return pairs_of_words(words).groupBy("c1", "c2").agg(F.sum("n").alias("n"))


def _totals(pairs: DataFrame, smoothing: int) -> DataFrame:
    """``c1``, its smoothed total over the alphabet and, in ``size``, how many characters that has."""
    every = pairs.select(F.explode(F.array("c1", "c2")).alias("c")).distinct()
    size = every.agg(F.count(F.lit(1)).alias("size")).scalar()
    # a character that nothing follows has smoothed counts alone
    seen = pairs.groupBy("c1").agg(F.sum("n").alias("n"))
    total = (F.coalesce("n", F.lit(0)) + F.lit(smoothing) * F.col("size")).alias("total")
    return every.select(F.col("c").alias("c1")).join(seen, "c1", "left").withColumn("size", size).select("c1", total)


def transition_probabilities(pairs: DataFrame, smoothing: int = 1) -> DataFrame:
    """Of the pairs that occur, and of the others of each first character as one row.

    ``c1, c2, n, p`` with the smoothed count; ``c2`` is null in the row that stands for
    every character that never follows ``c1``. Its size is that of the pairs seen, not
    of the alphabet squared.
    """
    pairs = materialize(pairs, "pairs")
    totals = _totals(pairs, smoothing)
    seen = pairs.select("c1", "c2", (F.col("n") + F.lit(smoothing)).alias("n")).join(totals, "c1")
    others = totals.select("c1", F.lit(None).cast("string").alias("c2"), F.lit(smoothing).cast("bigint").alias("n"), "total")
    return seen.unionByName(others).select("c1", "c2", "n", (F.col("n").cast("double") / F.col("total")).alias("p"))


def transition_table(pairs: DataFrame, smoothing: int = 1) -> DataFrame:
    """Probability of ``c2`` after ``c1`` over the whole character set, every cell written out.

    The alphabet squared is the size of this output; to score text use
    ``transition_probabilities``.
    """
    pairs = materialize(pairs, "pairs")
    every = pairs.select(F.explode(F.array("c1", "c2")).alias("c")).distinct()
    alphabet = every.agg(F.array_sort(F.collect_set("c")).alias("a")).scalar()
    grid = _totals(pairs, smoothing).select("c1", "total", F.explode(alphabet).alias("c2"))
    return grid.join(pairs, ["c1", "c2"], "left").select(
        "c1", "c2", (F.coalesce("n", F.lit(0)) + F.lit(smoothing)).alias("n"), "total",
    ).select("c1", "c2", "n", (F.col("n").cast("double") / F.col("total")).alias("p"))


def negative_log_likelihood(words: DataFrame, transitions: DataFrame) -> DataFrame:
    """Per word, the sum and the mean over its pairs of ``-log p``.

    ``transitions`` may be sparse: a row without ``c2`` holds for all pairs of its ``c1``
    that have no row. A pair the table lacks, or holds with probability 0, makes the
    word infinite.
    """
    known = transitions.where("c2 IS NOT NULL").select("c1", "c2", "p")
    others = transitions.where("c2 IS NULL").select("c1", F.col("p").alias("other"))
    scored = spread_join(spread_join(pairs_of_words(words), known, ["c1", "c2"], "left"), others, ["c1"], "left")
    p = F.coalesce(F.col("p"), F.col("other"), F.lit(0.0))
    cost = F.when(p > 0, -F.log(p)).otherwise(F.lit(float("inf")))
    return scored.groupBy("word", "n").agg(F.sum(cost).alias("nll"), F.avg(cost).alias("mean_nll"))


def vocabulary(words: DataFrame) -> DataFrame:
    """Each character's index, in order, the end mark at 0."""
    seen = words.select(
        F.explode(letters(F.col("word"))).alias("c")
    ).distinct()
    numbered = add_row_index(seen, ["c"], "i", start=1)
    mark = words.sparkSession.range(1).select(F.lit(END).alias("c"), F.col("id").alias("i"))
    return numbered.unionByName(mark)


def context_examples(words: DataFrame, size: int = 3) -> DataFrame:
    """Each character with the ``size`` before it, padded on the left with end marks."""
    pad = F.array(*[F.lit(END)] * size)
    padded = F.concat(pad, F.slice(characters(F.col("word")), F.lit(2), F.length("word") + 1))
    at = F.explode(F.sequence(F.lit(1), F.length("word") + 1))
    rows = words.withColumn("__c", padded).withColumn("__i", at)
    return rows.select(
        *words.columns,
        F.array_join(F.slice("__c", F.col("__i"), F.lit(size)), "").alias("context"),
        F.get("__c", F.col("__i") + F.lit(size - 1)).alias("next"),
    )
