"""Spelling variants: words one edit apart, grouped under the most frequent form.

The vocabulary is sorted and cut into files. In a sorted list, words that share their first
letters stand together, so the rows of the edit matrix that belong to a shared prefix are
computed once: a file holds, beside its words, the prefixes at which neighbouring words
part (by their longest common prefixes), depth by depth. A batch of words is compared with a
file by carrying the banded rows of all of them down these prefixes at the same time.

With one edit allowed, a row has three cells. As long as a prefix equals the word's own, the
row is (1, 0, 1). After the edit, each cell of value 1 lives on only where the next letter is
the word's next letter on that diagonal. A range of words whose shared prefix has no such cell
left is skipped, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.durable import fresh_path, materialize
from lakeops.llm.frames import lean
from lakeops.llm.store import Store

#: words of a file, and words compared at a time
FILE_WORDS = 100_000
BATCH_WORDS = 8_192
_LETTER_BITS = 21


# --- sorted words in files ----------------------------------------------------------------

@dataclass(frozen=True)
class Words:
    """Some words as code points in a row, and where each begins."""

    letters: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, words: list[str]) -> Words:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return cls(np.frombuffer("".join(words).encode("utf-32-le"), "<u4"), np.concatenate([[0], np.cumsum(lengths)]))

    def part(self, first: int, after: int) -> Words:
        at = self.at[first:after + 1]
        return Words(self.letters[at[0]:at[-1]], at - at[0])

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.at)

    def texts(self, of: np.ndarray | None = None) -> list[str]:
        rows = range(len(self.at) - 1) if of is None else of.tolist()
        return [self.letters[self.at[i]:self.at[i + 1]].tobytes().decode("utf-32-le") for i in rows]


@dataclass(frozen=True)
class Prefixes:
    """The distinct prefixes of a sorted list, from the empty one on by length and then by order.

    ``keys`` holds for each but the first the number of the prefix one letter shorter and the
    last letter; ``first`` for each the first of those one letter longer (they end where the next one's
    begin); ``word`` the word that a prefix is, or -1.
    """

    keys: np.ndarray
    first: np.ndarray
    word: np.ndarray

    @classmethod
    def of(cls, words: Words) -> Prefixes:
        lengths, begins = words.lengths, words.at[:-1]
        common = _common(words)
        keys, first, ends = [], [], [np.array([0 if len(lengths) and not lengths[0] else -1])]
        before, base = np.zeros(min(1, len(lengths)), np.int64), 0  # first words of the prefixes of the last length
        active, depth = np.arange(len(lengths)), 0
        while len(before):
            after = base + len(before)
            active = active[lengths[active] > depth]
            new = active[common[active] <= depth]
            keys.append((base + np.searchsorted(before, new, "right") - 1) << _LETTER_BITS | words.letters[begins[new] + depth].astype(np.int64))
            first.append(after + np.searchsorted(new, before))
            depth += 1
            ends.append(np.where(lengths[new] == depth, new, -1))
            before, base = new, after
        joined = lambda x, kind: np.concatenate([np.empty(0, kind), *x]).astype(kind)
        return cls(joined(keys, "<i8"), joined([*first, [base]], "<i4"), joined(ends, "<i4"))

    def below(self, prefix: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The prefix longer by a letter, or -1."""
        if not len(self.keys):
            return np.full(len(prefix), -1)
        wanted = prefix << _LETTER_BITS | letter
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, at + 1, -1)


def _common(words: Words) -> np.ndarray:
    """The length of the longest common prefix of each word and the one before it."""
    lengths, begins = words.lengths, words.at[:-1]
    common = np.zeros(len(lengths), np.int64)
    alive, depth = np.arange(1, len(lengths)), 0
    while len(alive):
        alive = alive[np.minimum(lengths[alive], lengths[alive - 1]) > depth]
        alive = alive[words.letters[begins[alive] + depth] == words.letters[begins[alive - 1] + depth]]
        depth += 1
        common[alive] = depth
    return common


@dataclass(frozen=True)
class Vocabulary:
    """Distinct words in code-point order with their counts, in files of the shared folder; how many words each file has."""

    store: Store
    sizes: dict[int, int]

    def words(self, file: int) -> Words:
        return Words(self.store.open(f"letters-{file}", "<u4"), self.store.open(f"at-{file}", "<i8"))

    def counts(self, file: int) -> np.ndarray:
        return self.store.open(f"n-{file}", "<i8")

    def prefixes(self, file: int) -> Prefixes:
        return Prefixes(*(self.store.open(f"{x}-{file}", k) for x, k in (("keys", "<i8"), ("first", "<i4"), ("word", "<i4"))))


def store_words(counts: DataFrame, file_words: int = FILE_WORDS) -> Vocabulary:
    """Sort the distinct, non-null ``word``s of ``counts`` with their ``n`` into files, a range of words each."""
    store = Store(fresh_path(counts.sparkSession, "vocabulary"))
    counts = materialize(counts.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL"), "words")
    files = max(1, -(-counts.count() // file_words))

    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, rows = TaskContext.get().partitionId(), [b for b in batches if len(b)]
        if not rows:
            return
        words = Words.of([w for b in rows for w in b.column(0).to_pylist()])
        prefixes = Prefixes.of(words)
        n = np.concatenate([b.column(1).to_numpy() for b in rows])
        for name, array in (
            ("letters", words.letters), ("at", words.at), ("n", n), ("keys", prefixes.keys), ("first", prefixes.first), ("word", prefixes.word),
        ):
            store.write(f"{name}-{file}", array)
        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([len(n)])], names=["file", "words"])

    # the order of UTF-8 bytes is that of code points
    ranges = counts.repartitionByRange(files, "word").sortWithinPartitions("word")
    # a row for each file
    made = ranges.mapInArrow(write, "file long, words long").collect()
    return Vocabulary(store, {r["file"]: r["words"] for r in sorted(made)})


# --- comparing ----------------------------------------------------------------------------

def near(words: Words, prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a word's place and the place of a word of the list that is exactly one edit apart, each once."""
    lengths = words.lengths
    # zeros, which no list holds, stand after each word's letters
    begins = words.at[:-1] + 2 * np.arange(len(lengths))
    letters = np.zeros(len(words.letters) + 2 * len(lengths), np.int64)
    letters[np.arange(len(words.letters)) + 2 * np.repeat(np.arange(len(lengths)), lengths)] = words.letters

    found: list[tuple[np.ndarray, np.ndarray]] = []
    own = np.arange(len(lengths)) if len(prefixes.first) > 1 else np.empty(0, np.int64)
    at = np.zeros(len(own), np.int64)
    # after the edit: the word, the prefix, and how many of the word's letters it stands for less its length
    edited = np.empty((3, 0), np.int64)
    depth = 0
    while len(own) or edited.shape[1]:
        # the edit is still to come: a word that ends here lacks the last letter
        ends = prefixes.word[at]
        lacks = (ends >= 0) & (lengths[own] == depth + 1)
        found.append((own[lacks], ends[lacks]))
        n = prefixes.first[at + 1] - prefixes.first[at]
        below = np.arange(n.sum()) + np.repeat(prefixes.first[at] - np.cumsum(n) + n, n)
        of = np.repeat(own, n)
        letter = prefixes.keys[below - 1] & (1 << _LETTER_BITS) - 1
        here = letters[begins[of] + depth]
        same = letter == here
        own, at = of[same], below[same]
        of, below, letter = of[~same], below[~same], letter[~same]
        replaced = lengths[of] > depth
        left_out = np.zeros(len(of), bool)
        left_out[replaced] = letters[begins[of[replaced]] + depth + 1] == letter[replaced]
        # what is one edit apart so far goes on by the word's next letter
        word, prefix, shift = edited
        if len(word):
            prefix = prefixes.below(prefix, letters[begins[word] + depth + shift])
            word, prefix, shift = word[prefix >= 0], prefix[prefix >= 0], shift[prefix >= 0]
        depth += 1
        edited = np.concatenate([
            [word, prefix, shift],
            [of, below, np.full(len(of), -1)],
            [of[replaced], below[replaced], np.zeros(replaced.sum(), np.int64)],
            [of[left_out], below[left_out], np.ones(left_out.sum(), np.int64)],
        ], axis=1)
        # the word is used up: it is near the one that ends here, and no longer one
        over = edited[0].size and lengths[edited[0]] == depth + edited[2]
        word, prefix, _ = edited[:, over] if edited.shape[1] else edited
        ends = prefixes.word[prefix]
        found.append((word[ends >= 0], ends[ends >= 0]))
        edited = edited[:, ~over] if edited.shape[1] else edited
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2


def nearest_forms(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """``word``, ``n``, ``n_near`` and the most frequent near word as ``best`` (ties: the smaller), with its ``best_n``.

    Both are null for a word with no near word. Tasks take batches of words and map the files
    one after the other; they hold a batch and the rows still alive.
    """
    schema = "word string, n long, n_near long, best string, best_n long"
    if not vocabulary.sizes:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(list(vocabulary.sizes.items()), "file long, words long")
    batches = files.select("file", "words", F.explode(F.sequence(F.lit(0).cast("long"), F.col("words") - 1, F.lit(BATCH_WORDS).cast("long"))).alias("first"))
    tasks = -(-sum(vocabulary.sizes.values()) // BATCH_WORDS) + len(vocabulary.sizes)

    @lean
    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for r in batch.to_pylist():
                after = min(r["first"] + BATCH_WORDS, r["words"])
                words, n = vocabulary.words(r["file"]).part(r["first"], after), vocabulary.counts(r["file"])[r["first"]:after]
                n_near, best_n, best = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.full(len(n), None, object)
                for file in vocabulary.sizes:  # in the words' order
                    counts = vocabulary.counts(file)
                    word, other = near(words, vocabulary.prefixes(file))
                    n_near += np.bincount(word, minlength=len(n))
                    order = np.lexsort((other, -counts[other], word))
                    word, other = word[order], other[order]
                    top = np.flatnonzero(np.diff(word, prepend=-1))
                    word, other = word[top], other[top]
                    more = counts[other] > best_n[word]
                    word, other = word[more], other[more]
                    best_n[word] = counts[other]
                    best[word] = vocabulary.words(file).texts(other)
                none = n_near == 0
                yield pa.RecordBatch.from_arrays([
                    pa.array(words.texts()), pa.array(n), pa.array(n_near), pa.array(best.tolist(), pa.string()), pa.array(best_n, mask=none),
                ], names=["word", "n", "n_near", "best", "best_n"])

    return batches.repartition(tasks).mapInArrow(compare, schema)


# --- groups -------------------------------------------------------------------------------

def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (distinct ``word``s, their ``form`` or null) with ``root``, the last form on the way from each word.

    Ways must end. Each round makes the steps twice as long, so as many rounds are needed as the
    longest way's length has binary digits.
    """
    forms = materialize(forms, "forms")
    ways = forms.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("on"))
        moved = materialize(ways.join(onward, "root").select("word", F.col("on").alias("root"), (F.col("on") != F.col("root")).alias("moved")), "ways")
        ways = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return forms.join(ways, "word")


def group(counts: DataFrame, times: float = 2, file_words: int = FILE_WORDS) -> DataFrame:
    """Each word of ``counts`` (distinct ``word``s with ``n``), its form and the root of its group.

    Two words are near if one inserted, deleted or replaced code point makes one the other. A word's
    ``form`` is its near word of the largest n (ties: the smallest word), if that is at least ``times`` its own n,
    else null; ``root`` is where following the forms ends, the word itself if it has none. Columns: word,
    form, root, n, n_near (0 if none) and form_n (null without a form). Null words are left out, no words give no rows.
    ``times`` must be over 1, so that no way leads back.
    """
    if times <= 1:
        raise ValueError("a form must be more frequent than its variants")
    vocabulary = store_words(counts, file_words)
    has = F.col("best_n") >= times * F.col("n")
    forms = nearest_forms(counts.sparkSession, vocabulary).select(
        "word", F.when(has, F.col("best")).alias("form"), "n", "n_near", F.when(has, F.col("best_n")).alias("form_n"),
    )
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
