"""Mixing sources to target weights.

A source's weight is its share of all words to the power of an exponent between 0 (all sources
alike) and 1 (as they are), normalised. Bisection finds the largest exponent at which the entropy
of the weights reaches its target, and the smallest at which no source is repeated more often than
the limit; the limit wins. The budget is what the least repeated source yields in one pass at
these weights, so every document is used at least once and none is lost.

The weights are realised as budgeted block permutations. Each source is a stream of passes, each
pass a new pseudo-random order of its documents, and its last pass ends with its share of the
budget. A document's place in the stream (words before it) gives the block of the mixture that it
falls into, so each block of ``block_words`` words holds every source by its weight; within a
block the order is again pseudo-random. Orders are hashes of document, pass and seed and are the
same in every run.

Places in a stream are running totals. No source comes into one task: words are summed over
ranges of the hash, totals run over these sums and then inside each range.

Null sources are one source of their own. Null and empty texts have no words and are placed like
others; sources without words are passed through once. Rows alike in id, source and text go the
same way and count once. An empty table gives an empty mixture. Columns that are added replace
columns of the same names.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage


@dataclass(frozen=True)
class Settings:
    """``entropy`` is a share of the largest possible one; ``passes`` is the repetition limit.

    The driver holds a row for each source and refuses more than ``most_sources``.
    """

    entropy: float = 0.95
    passes: float = 4.0
    block_words: int = 1 << 20
    range_rows: int = 20_000
    most_sources: int = 100_000
    seed: int = 17


def weights(words: list[int], exponent: float) -> list[float]:
    total = sum(words)
    raw = [(t / total) ** exponent for t in words]
    return [r / sum(raw) for r in raw]


def solve(words: list[int], settings: Settings = Settings()) -> float:
    """The exponent for sources of so many words, all positive."""

    def entropy(a: float) -> float:
        return -sum(w * log(w) for w in weights(words, a))

    def passes(a: float) -> float:
        each = [w / t for w, t in zip(weights(words, a), words, strict=True)]
        return max(each) / min(each)

    def bisect(fits) -> tuple[float, float]:
        low, high = 0.0, 1.0
        for _ in range(50):
            middle = (low + high) / 2
            low, high = (middle, high) if fits(middle) else (low, middle)
        return low, high

    if len(words) < 2:
        return 1.0
    # Entropy and passes both fall as the exponent grows.
    target = settings.entropy * log(len(words))
    by_entropy = 1.0 if entropy(1.0) >= target else bisect(lambda a: entropy(a) >= target)[0]
    by_passes = 0.0 if passes(0.0) <= settings.passes else bisect(lambda a: passes(a) > settings.passes)[1]
    return max(by_entropy, by_passes)


def quotas(totals: list[tuple[str, int]], settings: Settings) -> list[tuple[str, int, float, int]]:
    """(source, words, weight, words of the budget) of sources with their words."""
    full = [(name, t) for name, t in totals if t]
    ws = weights([t for _, t in full], solve([t for _, t in full], settings)) if full else []
    budget = max((t / w for (_, t), w in zip(full, ws, strict=True)), default=0.0)
    own = {name: (w, round(w * budget)) for (name, _), w in zip(full, ws, strict=True)}
    return [(name, t, *own.get(name, (0.0, 0))) for name, t in totals]


def _names(key: str, text: str, source: str) -> list[Column]:
    """128 bits that stand for a document, and the name of its source."""
    parts = [F.col(f"`{c}`").cast("string") for c in (source, key, text)]
    return [
        F.xxhash64(*parts).alias("_high"),
        F.xxhash64(F.lit(1), *reversed(parts)).alias("_low"),
        F.coalesce(F.concat(F.lit("="), parts[0]), F.lit("null")).alias("_source"),
    ]


def schedule(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", settings: Settings = Settings()) -> DataFrame:
    """A row for each document and pass: id, ``n_words``, ``weight``, ``pass``, ``block``, ``order``."""
    s = settings
    n = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    light = docs.select(*_names(key, text, source), F.col(f"`{key}`").alias("_id"), F.col(f"`{source}`").alias("_named"), n.alias("n_words"))
    light = stage(light.dropDuplicates(["_high", "_low"]), "documents")
    rows = light.groupBy("_source").agg(F.sum("n_words").alias("words"), F.count("*").alias("n")).limit(s.most_sources + 1).collect()
    if len(rows) > s.most_sources:
        raise ValueError(f"more than {s.most_sources} sources")
    shares = quotas(sorted((r["_source"], r["words"]) for r in rows), s)
    bits = max(4, ceil(log2(max(1, sum(r["n"] for r in rows) / s.range_rows))))
    shares = docs.sparkSession.createDataFrame(shares, "_source string, words long, weight double, quota long")

    passes = F.greatest(F.ceil(F.col("quota") / F.greatest("words", F.lit(1))), F.lit(1)).cast("int")
    runs = light.join(F.broadcast(shares), "_source").withColumn("pass", F.explode(F.sequence(F.lit(0), passes - 1)))
    runs = runs.withColumn("place", F.xxhash64("_high", "_low", "pass", F.lit(s.seed)))
    runs = runs.withColumn("range", F.shiftright("place", 64 - bits).cast("int"))
    at = ["_source", "pass", "range"]
    sums = runs.groupBy(*at).agg(F.sum("n_words").alias("inside"))
    earlier = W.partitionBy("_source", "pass").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*at, F.coalesce(F.sum("inside").over(earlier), F.lit(0)).alias("before"))
    ahead = F.sum("n_words").over(W.partitionBy(*at).orderBy("place", "_low").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.withColumn("ahead", F.coalesce(ahead, F.lit(0))).join(sums, at)
    start = F.col("pass") * F.col("words") + F.col("before") + F.col("ahead")
    runs = runs.withColumn("start", start).where((F.col("pass") == 0) | (F.col("start") < F.col("quota")))
    block = F.floor(F.col("start") / F.greatest(F.col("weight") * s.block_words, F.lit(1.0))).cast("long")
    return runs.select(
        "_high", "_low", F.col("_id").alias("id"), F.col("_named").alias("source"), "n_words", "weight",
        "pass", block.alias("block"), F.xxhash64("place", F.lit(s.seed)).alias("order"),
    )


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with each row as often as its source is passed, and ``pass``, ``block`` and ``order``."""
    added = ("pass", "block", "order")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    places = schedule(docs, key, text, source, settings).groupBy("_high", "_low").agg(F.collect_list(F.struct(*added)).alias("_places"))
    named = docs.select(*kept, *_names(key, text, source)[:2])
    # A document is passed a few times at most: the list of its places is as long.
    return named.join(places, ["_high", "_low"]).withColumn("_place", F.explode("_places")).select(*kept, "_place.*")
