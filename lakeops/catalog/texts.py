"""Text statistics: A20 to A22, E10, F14, F15, T4."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.durable import materialize
from lakeops.operators import text
from lakeops.operators.ordering import add_row_index

WORDS = r"""words AS (SELECT word, count(*) AS n FROM (
      SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1)"""
PAIRS = """each AS (SELECT word, n, CASE WHEN i = 0 THEN '.' ELSE substr(word, CAST(i AS INTEGER), 1) END AS c1,
                    CASE WHEN i = length(word) THEN '.' ELSE substr(word, CAST(i + 1 AS INTEGER), 1) END AS c2
             FROM (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM words)),
     pairs AS (SELECT c1, c2, CAST(sum(n) AS BIGINT) AS n FROM each GROUP BY 1, 2)"""
TABLE = """marks AS (SELECT DISTINCT c FROM (SELECT c1 AS c FROM pairs UNION SELECT c2 FROM pairs)),
     filled AS (SELECT a.c AS c1, b.c AS c2, coalesce(p.n, 0) + 1 AS n FROM marks a CROSS JOIN marks b
                LEFT JOIN pairs p ON p.c1 = a.c AND p.c2 = b.c),
     probs AS (SELECT c1, c2, n, n::DOUBLE / sum(n) OVER (PARTITION BY c1) AS p FROM filled)"""


def words(t):
    return text.word_counts(t.documents, "text")


@query("a20_text_lengths", f"""
    WITH {WORDS} SELECT CAST(min(length(word)) AS BIGINT) AS shortest, CAST(max(length(word)) AS BIGINT) AS longest,
    CAST(sum(n) AS BIGINT) AS n_words FROM words""")
def text_lengths(t):
    return words(t).agg(
        F.min(F.length("word")).cast("bigint").alias("shortest"),
        F.max(F.length("word")).cast("bigint").alias("longest"),
        F.sum("n").alias("n_words"),
    )


@query("a21_adjacent_pairs", f"WITH {WORDS}, {PAIRS} SELECT c1, c2, n FROM pairs")
def adjacent_pairs(t):
    return text.pair_counts(words(t))


@query("a22_transition_table", f"WITH {WORDS}, {PAIRS}, {TABLE} SELECT c1, c2, n, round(p, 9) AS p FROM probs")
def transition_table(t):
    return text.transition_table(text.pair_counts(words(t))).withColumn("p", F.round("p", 9))


@query("t4_items_by_count", f"""
    WITH {WORDS} SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS place FROM words""")
def items_by_count(t):
    return add_row_index(words(t), [F.desc("n"), "word"], "place", start=1)


@query("e10_text_likelihood", f"""
    WITH {WORDS}, {PAIRS}, {TABLE}
    SELECT word, round(sum(-ln(p)), 6) AS nll, round(avg(-ln(p)), 6) AS mean_nll
    FROM each JOIN probs USING (c1, c2) GROUP BY word""")
def text_likelihood(t):
    counted = materialize(words(t), "words")
    table = text.transition_probabilities(text.pair_counts(counted))
    scored = text.negative_log_likelihood(counted, table)
    return scored.select("word", F.round("nll", 6).alias("nll"), F.round("mean_nll", 6).alias("mean_nll"))


@query("f14_vocabulary", f"""
    WITH {WORDS}, letters AS (SELECT DISTINCT unnest(string_split(word, '')) AS c FROM words)
    SELECT c, row_number() OVER (ORDER BY c) AS i FROM letters UNION ALL SELECT '.', 0""")
def vocabulary(t):
    return text.vocabulary(words(t))


@query("f15_context_examples", f"""
    WITH {WORDS}, each AS (SELECT '...' || word || '.' AS w, n, unnest(range(1, length(word) + 2)) AS i FROM words)
    SELECT substr(w, CAST(i AS INTEGER), 3) AS context, substr(w, CAST(i + 3 AS INTEGER), 1) AS next,
           CAST(sum(n) AS BIGINT) AS n FROM each GROUP BY 1, 2""")
def context_examples(t):
    return text.context_examples(words(t), 3).groupBy("context", "next").agg(F.sum("n").alias("n"))
