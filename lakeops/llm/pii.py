"""Personal data: patterns, and terms that disclose what the patterns found.

Four kinds are found by their form. Each value found is a protected entity. Over
the whole corpus, the terms around an entity are compared with how often they
occur anywhere: the pointwise mutual information of term and entity, as a share of
the entity's own information content, is how much of it the term gives away. Terms
beyond a threshold are personal data too, wherever they stand, and are generalised to
their kind or, where they disclose nearly all, removed. A term that most texts hold without
the entity is none, whatever its share.

Three passes over the texts: the words near entities, the texts that hold each term,
and the places of the terms that may disclose. A term may if it would, did all texts
with the rarer of term and entity hold both; only such terms are joined.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.durable import materialize
from lakeops.llm.frames import TEXT, as_text, bound_batches, free_prefix, lean, map_batches, map_texts, named
from lakeops.llm.words import LETTERED, Block, small_blocks
from lakeops.operators.skew import spread_join

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# terms that may disclose, as one bit for each value of their hash's low bits: 4 MB whatever their number
_BITS, _PAGE = 1 << 25, 1 << 15

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# an address, card or phone number lies inside one run of these
_NUMERIC = re.compile(r"[0-9+][0-9 ().+-]*")
# starting behind a digit finds nothing that starting before it did not
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Settings:
    """``window`` code points on either side are an entity's context.

    Every pair of term and entity is judged. What speaks for it counts in full from
    ``support`` different contexts on, and in proportion below that. A word under
    ``shortest`` characters is judged unless it is in lower case, as "at" is.
    Of the texts with a term, ``likely`` is the share that must hold the entity too, at the lower end
    of its confidence interval (one standard error); so a word that other texts hold as
    well is no sure sign, however rare the entity is and however large the corpus. ``generalise`` and ``remove`` are shares of the entity's information content.
    """

    window: int = 80
    shortest: int = 3
    support: int = 3
    likely: float = 0.5
    generalise: float = 0.8
    remove: float = 0.95


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", at + 1)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of every base match, by kind and then start."""
    found: list[list[tuple[int, int]]] = [list(_emails(text)), [], [], []]
    for run in _NUMERIC.finditer(text):
        a, b = run.span()
        if b - a < 7:  # the shortest is an address: 1.2.3.4
            if "+" not in run.group():
                continue
        for m in _IP.finditer(text, a, b):
            if all(map(_small, m.group().split("."))):
                found[1].append(m.span())
        for m in _CARD.finditer(text, a, b):
            if m.end() - m.start() >= 16:
                digits = _digits(m.group())
                if len(digits) <= 19 and len(digits) >= 16 and luhn(digits):
                    found[2].append(m.span())
        for m in _PHONE.finditer(text, a, b):
            if 8 <= len(_digits(m.group())) <= 15:
                found[3].append(m.span())
    return [(kind, s, e) for kind, spans in enumerate(found) for s, e in spans]


def _entity(kind: int, value: str) -> str:
    """One spelling for each value."""
    return f"{KINDS[kind]}:{value.lower() if kind < 2 else _digits(value)}"


def _entities(text: str, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The hashes of a text's distinct entities."""
    block = Block([_entity(kind, text[start:end]).encode() for kind, start, end in spans], LETTERED)
    own = [_fold(block.hashes[a:b]) for a, b in zip(block.offsets[:-1], block.offsets[1:])]
    return np.unique(np.array(own, np.uint64)).view(np.int64)


def _merged(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for _, start, end in sorted(spans, key=lambda x: x[1]):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _around(text: str, start: int, end: int, covered: tuple[list[int], list[int]], s: Settings) -> Iterator[str]:
    """The words within the window on either side of a span, but those that spans cover in part."""
    starts, ends = covered
    for a, b in ((max(0, start - s.window), start), (end, min(len(text), end + s.window))):
        for m in _WORD.finditer(text, a, b):
            i, j = m.span()
            # a word that the edge of the window or the entity cuts is none
            if (i == a and i > 0 and _WORD.match(text[i - 1])) or (j == b and j < len(text) and _WORD.match(text[j])):
                continue
            before = bisect_left(starts, j) - 1  # the last stretch that begins before the word ends
            if (j - i >= s.shortest or not m.group().islower()) and (before < 0 or ends[before] <= i):
                yield m.group()


def _contexts(texts: list[str], spans: list[list[tuple[int, int, int]]], s: Settings) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each text its entities, and the distinct triples of entity, context and word near it, all as hashes."""
    strings: list[bytes] = []
    places: list[list[tuple[int, int, int]]] = []
    for text, own in zip(texts, spans):
        covered, mine = _merged(own), []
        for kind, start, end in own:
            entity = len(strings)
            strings.append(_entity(kind, text[start:end]).encode())
            strings += [w.encode() for w in _around(text, start, end, covered, s)]
            mine.append((entity, entity + 1, len(strings)))
        places.append(mine)
    # a word's hash is that of its text; an entity is hashed by all its words in order
    block = Block(strings, LETTERED)
    words = block.hashes[np.minimum(block.offsets[:-1], max(len(block.hashes) - 1, 0))] if len(block.hashes) else np.empty(0, np.uint64)
    entities, out = [], []
    for mine in places:
        own, rows = [], [np.empty((0, 3), np.uint64)]
        for entity, first, after in mine:
            whole = _fold(block.hashes[block.offsets[entity]:block.offsets[entity + 1]])
            own.append(whole)
            rows.append(np.column_stack([np.full(after - first, whole, np.uint64), np.full(after - first, _fold(words[first:after]), np.uint64), words[first:after]]))
        entities.append(np.unique(np.array(own, np.uint64)).view(np.int64))
        out.append(_distinct_rows(np.concatenate(rows)).view(np.int64))
    return entities, out


def _distinct_rows(a: np.ndarray) -> np.ndarray:
    a = a[np.lexsort(a.T)]
    return a[np.concatenate([[True], (a[1:] != a[:-1]).any(axis=1)])] if len(a) else a


def _places(texts: list[str], spans: list[list[tuple[int, int, int]]], bits: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """For each text the words whose bit is set: term, start, end, and whether it is free of base spans."""
    data = [t.encode() for t in texts]
    block = Block(data, LETTERED)
    at = (block.hashes & np.uint64(_BITS - 1)).astype(np.int64)
    hits = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
    first = np.searchsorted(hits, block.offsets)
    out, begin = [], 0
    for i, (text, own) in enumerate(zip(texts, spans)):
        mine = hits[first[i]:first[i + 1]]
        starts, ends = block.starts[mine] - begin, block.ends[mine] - begin
        begin += len(data[i]) + 1
        if len(mine) and len(data[i]) != len(text):
            points = np.zeros(len(data[i]) + 1, np.int32)
            np.cumsum(np.frombuffer(data[i], np.uint8) & 0xC0 != 0x80, out=points[1:])
            starts, ends = points[starts], points[ends]
        _, ends_of_spans = covered = [np.array(x, np.int64) for x in _merged(own)]
        # the last stretch that begins before a word ends
        before = np.searchsorted(covered[0], ends, "left") - 1
        free = (before < 0) | (ends_of_spans[before] <= starts) if len(ends_of_spans) else np.ones(len(mine), bool)
        out.append((block.hashes[mine].view(np.int64), starts.astype(np.int32), ends.astype(np.int32), free))
    return out


def _lists(parts: list, names: list[str] | None = None) -> pa.Array:
    """A list for each row: of its numbers or, with ``names``, of structs made of its columns."""
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(p[0]) if names else len(p) for p in parts])]).astype(np.int32))
    if not names:
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *parts])))
    columns = [pa.array(np.concatenate(c)) for c in zip(*parts)]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, names=names))


def _fold(hashes: np.ndarray) -> int:
    total = len(hashes)
    for h in hashes.tolist():
        total = (total * 0x9E3779B97F4A7C15 + h) % (1 << 64)
    return total


_SPAN = "struct<kind:string,start:int,end:int>"
_CONTEXT = "struct<entity:bigint,context:bigint,term:bigint>"
_PLACE = "struct<term:bigint,start:int,end:int,free:boolean>"


def detect(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The ``entities`` of each row that has any, and the words ``around`` them."""
    def build():
        def work(texts, rows):
            whole = [as_text(t) for t in texts]
            entities, around = _contexts(whole, [base_spans(t) for t in whole], settings)
            return [_lists(entities), _lists([tuple(a.T) for a in around], ["entity", "context", "term"])]
        return work
    return map_texts(docs, [], text, f"entities array<bigint>, around array<{_CONTEXT}>", build).where(F.size("entities") > 0)


def locate(docs: DataFrame, terms: DataFrame, keep: list[str], text: str = "text", settings: Settings = Settings(), prefix: str = "") -> DataFrame:
    """The ``keep`` columns with ``base`` spans, ``entities`` and the ``places`` of ``terms`` in each row's whole text.

    ``terms`` go to the tasks as bits, so a word that shares its bit with one of them
    has a place too; a join on the term rules it out.
    """
    at = F.pmod("term", F.lit(_BITS))
    pages = terms.select(F.floor(at / _PAGE).alias("page"), (at % _PAGE).alias("bit")).repartition("page").groupBy("page").agg(
        F.bitmap_construct_agg("bit").alias("bits")
    ).collect()  # at most _BITS / _PAGE rows of 4 KB
    bits = np.zeros(_BITS // 8, np.uint8)
    for r in pages:
        bits[r["page"] * _PAGE // 8:(r["page"] + 1) * _PAGE // 8] = np.frombuffer(r["bits"], np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def build():
        held = np.frombuffer(sent.value, np.uint8)

        def work(texts, rows):
            whole = [as_text(t) for t in texts]
            spans = [base_spans(t) for t in whole]
            return [
                [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in own] for own in spans],
                _lists([_entities(t, own) for t, own in zip(whole, spans)]),
                _lists(_places(whole, spans, held), ["term", "start", "end", "free"]),
            ]
        return work
    return map_texts(docs, keep, text, f"base array<{_SPAN}>, entities array<bigint>, places array<{_PLACE}>", build, prefix)


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``term`` (hash) and ``n_docs``, the number of rows whose text holds it."""
    @lean
    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for _, texts in small_blocks(batches, TEXT):
            block = Block(texts, LETTERED)
            owner = block.owners().astype(np.uint64)
            # a term once for each text that holds it
            _, first = np.unique(block.hashes + owner * np.uint64(0x9E3779B97F4A7C15), return_index=True)
            held.append(np.unique(block.hashes[first], return_counts=True))
            size += len(held[-1][0])
            if size > 2_000_000:
                held = [_added(held)]
                if len(held[0][0]) > 1_000_000:
                    yield _counted(held.pop())
                size = sum(len(h) for h, _ in held)
        if held:
            yield _counted(_added(held))

    def _added(held):
        hashes, inverse = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        return hashes, np.bincount(inverse, np.concatenate([c for _, c in held]), len(hashes)).astype(np.int64)

    def _counted(pair):
        return pa.RecordBatch.from_arrays([pa.array(pair[0].view(np.int64)), pa.array(pair[1].astype(np.int64))], names=["term", "n"])

    return bound_batches(docs).select(named(text).cast("string").alias(TEXT)).mapInArrow(count, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("n_docs")
    )


def _at_least(n_both: Column) -> Column:
    """The lower end of the score interval, at one standard error, for the share of a term's texts that hold the entity."""
    n, share = F.col("n_docs").cast("double"), n_both / F.col("n_docs")
    return (share + 0.5 / n - F.sqrt(share * (1 - share) / n + 0.25 / (n * n))) / (1 + 1 / n)


def _share(n_both: Column, n_docs: int, settings: Settings) -> Column:
    """How much of the entity's information content the term gives away; null unless the entity is likely where the term is."""
    trust = F.least(F.lit(1.0), F.col("contexts") / F.lit(float(max(settings.support, 1))))
    lift = n_both * F.lit(float(n_docs)) / F.col("n_docs") / F.col("n_entity")
    share = F.log2(trust * lift + 1 - trust) / F.log2(F.lit(float(max(n_docs, 1))) / F.col("n_entity"))
    return F.when(_at_least(n_both) >= settings.likely - 1e-9, share)


def candidates(near: DataFrame, counts: DataFrame, n_docs: int, settings: Settings = Settings()) -> DataFrame:
    """``entity``, ``term`` and their counts, for the pairs that may reach the lower threshold.

    ``near`` is what ``detect`` returns. Of a pair no more texts hold both than hold
    the rarer one; pairs that stay below the threshold even so are left out. A word beside
    many entities is in many pairs before that, and in few after it: those of entities that half of its texts hold.
    """
    entities = near.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    pairs = near.select(F.explode("around").alias("w")).select("w.*").groupBy("entity", "term").agg(
        F.countDistinct("context").alias("contexts")
    )
    return spread_join(materialize(pairs.join(entities, "entity"), "pairs"), counts, ["term"]).where(F.col("n_entity") < n_docs).where(
        _share(F.least("n_docs", "n_entity"), n_docs, settings) >= settings.generalise
    )


def disclosing(pairs: DataFrame, places: DataFrame, carriers: DataFrame, n_docs: int, settings: Settings = Settings()) -> DataFrame:
    """``term`` and its highest ``share`` of any entity, for those at or beyond the lower threshold.

    ``places`` has the distinct ``row`` and ``term`` of the rows with entities, ``carriers``
    their distinct ``row`` and ``entity``. How much likelier the term makes the entity is
    drawn towards 1, which says nothing, where fewer than ``support`` different contexts
    hold the pair. Contexts of equal words are one piece of evidence, so copies of a
    passage add none. An entity that every document holds has no information content
    and discloses nothing.
    """
    both = places.join(pairs.select("entity", "term"), "term").join(carriers, ["row", "entity"], "left_semi").groupBy(
        "entity", "term"
    ).agg(F.count(F.lit(1)).alias("n_both"))
    return pairs.join(both, ["entity", "term"]).select("term", _share(F.col("n_both"), n_docs, settings).alias("share")).where(
        F.col("share") >= settings.generalise
    ).groupBy("term").agg(F.max("share").alias("share"))


def find_personal(docs: DataFrame, keep: list[str], text: str = "text", settings: Settings = Settings(), prefix: str = "") -> DataFrame:
    """The ``keep`` columns with ``base`` spans and ``terms`` of each row's whole text.

    ``base`` holds kind, start and end (code points, end exclusive) by kind as listed in
    ``KINDS`` and then start; matches of one kind do not overlap, those of two kinds may.
    ``terms`` holds start, end and share of the disclosing words, by start: all places in
    all texts of a word that discloses an entity it is near to somewhere.
    Null and empty texts have none. Repeated rows are rows of their own.
    """
    row, entities, places = f"{prefix}row", f"{prefix}entities", f"{prefix}places"
    n_docs = docs.count()
    near = materialize(detect(docs, text, settings), "near")
    pairs = materialize(candidates(near, term_counts(docs, text), n_docs, settings), "candidates")
    # the numbers of the rows hold for the written copy
    found = materialize(
        locate(docs, pairs.select("term"), keep, text, settings, prefix).withColumn(row, F.monotonically_increasing_id()), "personal"
    )
    carriers = found.where(F.size(named(entities)) > 0)
    held = carriers.select(
        named(row).alias("row"), F.explode(F.array_distinct(F.transform(named(places), lambda x: x["term"]))).alias("term")
    )
    carried = carriers.select(named(row).alias("row"), F.explode(named(entities)).alias("entity"))
    flagged = materialize(disclosing(pairs, held, carried, n_docs, settings), "disclosing")
    words = found.select(named(row).alias("row"), F.explode(named(places)).alias("w")).select("row", "w.*").where("free").drop("free")
    terms = materialize(
        spread_join(words, flagged, ["term"])
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms")),
        "terms",
    ).select(F.col("row").alias(row), F.col("terms").alias(f"{prefix}terms"))
    kept = [c for c in found.columns if c not in (row, entities, places)]
    empty = F.array().cast("array<struct<start:int,end:int,share:double>>")
    return found.select(*[named(c) for c in (*kept, row)]).join(terms, row, "left").withColumn(
        f"{prefix}terms", F.coalesce(named(f"{prefix}terms"), empty)
    ).drop(row)


def joined(spans: Column) -> Column:
    """Spans of kind, start and end as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def sanitise(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with personal data taken out of ``text``.

    A base span becomes its kind in brackets, a disclosing term ``[term]`` or, beyond
    the upper threshold, nothing. Of spans that overlap the one that starts first, or
    is listed first, names the whole. Other columns and null texts stay.
    """
    prefix = free_prefix(docs)
    found = find_personal(docs, docs.columns, text, settings, prefix)
    at = [found.columns.index(c) for c in (f"{prefix}base", f"{prefix}terms")]
    names, place, width = docs.columns, docs.columns.index(text), len(docs.columns)

    def run(batches):
        for batch in batches:
            columns = batch.columns[:width]
            base, terms = (batch.column(i).to_pylist() for i in at)
            texts = columns[place].to_pylist()
            columns[place] = pa.array([
                None if t is None else redacted(t, b, w, settings) for t, b, w in zip(texts, base, terms)
            ], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(found, run, docs.schema)


def redacted(text: str, base: list[dict], terms: list[dict], settings: Settings = Settings()) -> str:
    spans = [(s["start"], s["end"], f"[{s['kind']}]") for s in base]
    spans += [(s["start"], s["end"], "" if s["share"] >= settings.remove else f"[{TERM}]") for s in terms]
    if not spans:
        return text
    out, done, upto = [], 0, 0
    for start, end, name in sorted(spans, key=lambda x: x[0]):
        if start >= upto:
            out += [text[done:start], name]
            done = upto = end
        elif end > upto:
            done = upto = end
    out.append(text[done:])
    return "".join(out)
