"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from the URLs that a rule judges. Everything is built from Spark's
own functions and its machine-learning library.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.frames import free_prefix, named

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    """``most_rows`` bounds the distinct labelled URLs that are fitted.

    Suffixes are hashed into ``buckets``, so their statistics have a fixed size;
    ``prior`` is the weight of the overall rate in each.
    """

    most_rows: int = 10_000
    buckets: int = 1024
    prior: float = 5.0
    rounds: int = 10
    depth: int = 4
    seed: int = 11


def after_scheme(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """From behind the first ``://`` to a slash, question mark, hash or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """From behind the host to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(hosts: Column, paths: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null without one; the earlier of two as long.

    A rule is a host and a path in one. It fits the host and all its subdomains, where
    the URL's path starts with the rule's.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, rule in reversed(sorted(rules, key=lambda r: -len(r[1]))):
        domain, slash, rest = rule.partition("/")
        fits = (F.concat(F.lit("."), hosts).endswith(F.lit("." + domain))) & paths.startswith(F.lit(slash + rest))
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{pattern}]", ""))


def _entropy(text: Column) -> Column:
    """Bits a character, from how often each occurs."""
    n = F.length(text)
    times = F.transform(
        F.filter(F.array_distinct(F.split(text, "")), lambda c: c != ""),
        lambda c: (n - F.length(F.replace(text, c, F.lit("")))).cast("double"),
    )
    return F.when(n > 0, F.log2(n.cast("double")) - F.aggregate(times, F.lit(0.0), lambda s, k: s + k * F.log2(k)) / n).otherwise(0.0)


def suffix(hosts: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(hosts, ".", -2)


def lexical(url: Column, hosts: Column, paths: Column) -> dict[str, Column]:
    """The features of a URL's form; null is the empty URL."""
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    size = lambda c: F.length(c).cast("double")
    return {
        "length": size(text), "host_length": size(hosts), "path_length": size(paths), "query_length": size(query),
        "depth": _count(paths, "/").cast("double"), "labels": (_count(hosts, ".") + 1).cast("double"),
        "digit_ratio": F.when(F.length(text) > 0, _count(text, "0-9") / F.length(text)).otherwise(0.0),
        "host_digits": _count(hosts, "0-9").cast("double"), "hyphens": _count(text, "\\-").cast("double"),
        "entropy": _entropy(text), "host_entropy": _entropy(hosts),
        "parameters": F.when(query != "", _count(query, "&") + 1).otherwise(0).cast("double"),
        "fragment": text.contains("#").cast("double"), "secure": text.startswith("https:").cast("double"),
    }


class Model:
    """Suffix statistics and trees, or one verdict where the labels are all alike."""

    def __init__(self, rates: list[float], counts: list[float], trees, only: str | None, settings: Settings):
        self.rates, self.counts, self.trees, self.only, self.settings = rates, counts, trees, only, settings

    def features(self, url: Column, hosts: Column, paths: Column) -> dict[str, Column]:
        bucket = _bucket(hosts, self.settings)
        table = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), bucket + 1)
        return {**lexical(url, hosts, paths), "suffix_rate": table(self.rates), "suffix_count": table(self.counts)}

    def verdict(self, df: DataFrame, url: str, hosts: str, paths: str, name: str) -> DataFrame:
        """``df`` with the verdict of the trees in column ``name``."""
        if self.only:
            return df.withColumn(name, F.lit(self.only))
        p = free_prefix(df)
        made = self.features(named(url), named(hosts), named(paths))
        wide = df.select("*", *[c.alias(f"{p}{k}") for k, c in made.items()])
        joined = VectorAssembler(inputCols=[f"{p}{k}" for k in made], outputCol=f"{p}features").transform(wide)
        trees = self.trees.copy({})
        for param, value in (("featuresCol", "features"), ("predictionCol", "prediction"),
                             ("probabilityCol", "probability"), ("rawPredictionCol", "raw")):
            trees.set(trees.getParam(param), p + value)
        judged = trees.transform(joined)
        return judged.select(
            *[named(c) for c in df.columns], F.when(F.col(f"{p}prediction") > 0.5, BLOCK).otherwise(ALLOW).alias(name)
        )


def _bucket(hosts: Column, settings: Settings) -> Column:
    return F.pmod(F.xxhash64(suffix(hosts)), F.lit(settings.buckets)).cast("int")


def fit(labelled: DataFrame, url: str = "url", label: str = "verdict", settings: Settings = Settings()) -> Model:
    """A model of labelled URLs; about ``most_rows`` distinct ones, chosen by a hash, are fitted.

    Suffix statistics cover all distinct labelled URLs. Null URLs and labels are left
    out. Without any label, or with one alone, every verdict is that one (allow).
    """
    rows = labelled.where(named(url).isNotNull() & named(label).isNotNull()).groupBy(named(url).alias("url")).agg(
        (F.avg((named(label) == BLOCK).cast("double")) >= 0.5).cast("double").alias("label")
    ).withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    # a row for each bucket
    stats = rows.groupBy(_bucket(F.col("host"), settings).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked")
    ).collect()
    n, blocked = sum(r["n"] for r in stats), sum(r["blocked"] for r in stats)
    if blocked in (0, n):
        return Model([], [], None, BLOCK if n and blocked else ALLOW, settings)
    rate = blocked / n
    rates, counts = [rate] * settings.buckets, [0.0] * settings.buckets
    for r in stats:
        rates[r["bucket"]] = (r["blocked"] + settings.prior * rate) / (r["n"] + settings.prior)
        counts[r["bucket"]] = math.log1p(r["n"] / n * 1000)
    model = Model(rates, counts, None, None, settings)
    share = 1 << 30
    chosen = rows.where(F.pmod(F.xxhash64("url"), F.lit(share)) < int(share * min(1.0, settings.most_rows / n)) + 1)
    made = model.features(F.col("url"), F.col("host"), F.col("path"))
    wide = chosen.select("label", *[c.alias(k) for k, c in made.items()])
    joined = VectorAssembler(inputCols=list(made), outputCol="features").transform(wide).select("label", "features")
    model.trees = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=settings.rounds, maxDepth=settings.depth, stepSize=0.3, seed=settings.seed,
    ).fit(joined.coalesce(2))
    return model


def judge(pages: DataFrame, rules: list[tuple[str, str]], keep: list[str], url: str = "url", settings: Settings = Settings()) -> DataFrame:
    """The ``keep`` columns with ``host``, ``path``, ``rule`` and ``verdict`` of every URL.

    ``rules`` are pairs of verdict and rule, a stated list. The trees are fitted on the
    URLs that a rule judges and judge the others. A null or empty URL has an empty host
    and path and, as any other, a verdict. Kept columns of these names give way.
    """
    new = ("host", "path", "rule", "verdict")
    kept = [c for c in keep if c.lower() not in new]
    p = free_prefix(pages)
    whole, ruled_as, learned = (p + x for x in ("url", "ruled", "learned"))
    rows = pages.select(*[named(c) for c in kept], named(url).cast("string").alias(whole)) \
        .withColumn("host", host(F.col(whole))).withColumn("path", path(F.col(whole)))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = rows.withColumn("rule", name).withColumn(ruled_as, verdict)
    model = fit(ruled.where(F.col(ruled_as).isNotNull()), whole, ruled_as, settings)
    judged = model.verdict(ruled, whole, "host", "path", learned)
    return judged.select(
        *[named(c) for c in kept], "host", "path", "rule", F.coalesce(ruled_as, learned).alias("verdict"),
    )
