"""Frames and words to make texts of."""

import pytest
from pyspark.sql import types as T

ENGLISH = "the of and to in is that for was with his they have from this had not are but what all were when your can said".split()
GERMAN = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass".split()


def sentence(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ","]) for _ in range(n))

#: an id, a text, and columns whose names the operators use for their own results
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("hits", T.StringType()), T.StructField("ids", T.StringType()),
    T.StructField("n_shingles", T.StringType()), T.StructField("__row", T.StringType()), T.StructField("a.b", T.StringType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of (id, text) or (id, text, lang) with clashing and awkward columns."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", "h", "i", "n", "r", "d") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts, "doc_id")
    return make


#: null, empty, blank, one word, no letter, bytes of several alphabets, ties and repeats are in here
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "1234 !!"), (6, "ñandú 漢字 😀 café"), (7, "word"), (None, "no id at all here"), (None, None)]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
