"""Language identification by compression.

Each language has a dictionary of raw training text. A text is compressed with
every language's dictionary, a piece at a time so that the dictionary stays in
reach, and belongs to the language that needs the fewest bytes. The last bytes of every
text are compressed at further levels too and all sizes added up: in a text of a few words one
byte more or less says little, in a long one the end weighs little. Where the two best
differ by too little, the text is rejected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.durable import materialize
from lakeops.llm.frames import as_text, map_texts, named

UNDETERMINED = "und"
# a text's place in the order of the sample, and the ranges that are summed up before texts are put in order
_PLACES, _RANGES = 1 << 30, 1 << 10


@dataclass(frozen=True)
class Settings:
    """``sample_bytes`` bounds what is read of each language to build its dictionary.

    ``level`` is for whole texts, ``fine_levels`` for their last ``tail_bytes``, whatever their length.
    """

    dictionary_bytes: int = 112_640
    sample_bytes: int = 2 << 20
    piece_bytes: int = 4096
    level: int = 6
    fine_levels: tuple[int, ...] = (3, 9)
    tail_bytes: int = 300
    min_margin: float = 0.002
    sharpness: float = 40.0


def learn(texts: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> dict[str, bytes]:
    """A dictionary for each non-null language of the labelled rows.

    The distinct texts of each language are read in the order of their hash up to
    ``sample_bytes``; of a text that goes beyond, the first bytes. So every language has
    a text, copies are chosen, or not, together, and count once. Lines that more than one
    chosen text holds say little about a language and are left out; the others
    fill the dictionary in the order of their hash. The languages with most text come
    first. Empty input gives no languages.
    """
    rows = texts.where(named(lang).isNotNull() & (F.length(named(text)) > 0)).select(
        named(lang).cast("string").alias("lang"), named(text).cast("string").alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    distinct = materialize(
        rows.groupBy("lang", "key").agg(F.max(F.octet_length("text")).cast("long").alias("bytes"))
        .withColumn("place", F.pmod(F.xxhash64("key"), F.lit(_PLACES))), "distinct",
    )
    bound = F.lit(max(settings.sample_bytes, 1)).cast("long")
    # the places are cut into few ranges, and only texts in those that are read are put in order
    part = F.floor(F.col("place") / (_PLACES // _RANGES))
    ranges = distinct.groupBy("lang", part.alias("part")).agg(F.sum("bytes").alias("bytes"))
    upto = F.sum("bytes").over(Window.partitionBy("lang").orderBy("part"))
    sizes = ranges.withColumn("before", upto - F.col("bytes")).groupBy("lang").agg(
        F.sum("bytes").alias("bytes"), F.max(F.when(F.col("before") < bound, F.col("part"))).alias("last"),
    ).orderBy(F.desc("bytes"), "lang").collect()  # one row a language
    if not sizes:
        return {}
    last = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], r["last"])])
    upto = F.sum("bytes").over(Window.partitionBy("lang").orderBy("place", "key"))
    chosen = distinct.where(part <= last[F.col("lang")]).withColumn("left", bound - upto + F.col("bytes")).where("left > 0")
    near = rows.withColumn("place", F.pmod(F.xxhash64("key"), F.lit(_PLACES))).where(part <= last[F.col("lang")])
    # a character that the bound cuts is left out
    head = F.make_valid_utf8(F.substring(F.col("text").cast("binary"), F.lit(1), F.col("left").cast("int")).cast("string"))
    picked = materialize(
        near.groupBy("lang", "key").agg(F.first("text").alias("text")).join(chosen.select("lang", "key", "bytes", "left"), ["lang", "key"])
        .select("lang", "key", F.when(F.col("bytes") <= F.col("left"), F.col("text")).otherwise(F.rtrim(head, F.lit("\uFFFD"))).alias("text")),
        "picked",
    )
    # a line that two different texts share is left out
    lines = picked.select(
        "lang", "key", F.explode(F.array_distinct(F.split(F.lower("text"), "\n"))).alias("line"),
    )
    fallback = picked.groupBy("lang").agg(F.min(F.lower("text")).alias("line"))
    single = lines.where(F.length("line") > 0).groupBy("line").agg(
        F.count(F.lit(1)).alias("texts"), F.first("lang").alias("lang"),
    ).where("texts = 1")
    found: dict[str, list[tuple[int, str]]] = {r["lang"]: [] for r in sizes}
    for r in single.select("lang", "line", F.xxhash64("line").alias("at")).collect():  # at most the sample's bytes
        found[r["lang"]].append((r["at"], r["line"]))
    spare = {r["lang"]: r["line"] for r in fallback.collect()}
    made = {}
    for name in found:
        parts, size = [], 0
        for _, line in sorted(found[name]) or [(0, spare[name])]:
            data = line.encode()
            parts.append(data)
            size += len(data) + 1
            if size >= settings.dictionary_bytes:
                break
        # the end of a dictionary is the part nearest to the text
        made[name] = b"\n".join(parts)[-settings.dictionary_bytes:]
    return made


class Classifier:
    """Compressors for each language, in one task."""

    def __init__(self, dictionaries: dict[str, bytes], settings: Settings):
        self.settings = settings
        self.names = list(dictionaries)
        self.at = {
            level: [self._compressor(dictionaries[n], level) for n in self.names]
            for level in (settings.level, *settings.fine_levels)
        }

    @staticmethod
    def _compressor(data: bytes, level: int) -> zstandard.ZstdCompressor:
        # shorter than eight bytes is no dictionary
        raw = zstandard.ZstdCompressionDict(data.ljust(8, b"\n"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=level)
        return zstandard.ZstdCompressor(
            level=level, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False,
        )

    def sizes(self, text: str) -> list[int]:
        data, step = text.lower().encode(), self.settings.piece_bytes
        pieces = [data[i:i + step] for i in range(0, len(data), step)]
        total = [sum(len(c.compress(p)) for p in pieces) for c in self.at[self.settings.level]]
        tail = data[-self.settings.tail_bytes:]
        for level in self.settings.fine_levels:
            total = [a + len(c.compress(tail)) for a, c in zip(total, self.at[level])]
        return total

    def label(self, text: str) -> tuple[str, float, float, bool]:
        """Language, confidence, margin and whether the margin is too narrow."""
        if not self.names or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = sorted(sizes)[1:]
        margin = (rest[0] - sizes[best]) / rest[0] if rest else 1.0
        sharp = self.settings.sharpness
        score = 1 / sum(math.exp(-sharp * (s - sizes[best]) / sizes[best]) for s in sizes)
        return self.names[best], score, margin, margin < self.settings.min_margin


RESULT = "lang_pred string, score double, margin double, rejected boolean"


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str],
    text: str = "text", settings: Settings = Settings(), prefix: str = "",
) -> DataFrame:
    """The ``keep`` columns of each row with ``lang_pred``, ``score``, ``margin`` and ``rejected``.

    Whole texts are compressed. A text that is null or has no letter, or any text
    where no language was learned, is ``und`` with score 0 and rejected; a tie goes
    to the language first learned and, as its margin is 0, is rejected. The dictionaries are
    sent to the tasks: ``dictionary_bytes`` for each language.
    """
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def build():
        classifier = Classifier(sent.value, settings)

        def work(texts, rows):
            labels = [classifier.label(as_text(t)) for t in texts]
            return [list(c) for c in zip(*labels)] if labels else [[]] * 4
        return work

    return map_texts(docs, keep, text, RESULT, build, prefix)
