"""URL filter: listed rules first, a ratio of character language models for the rest.

Rules name a host (with its subdomains) and the beginning of a path; the longest that fits wins.
URLs that a rule accepts or rejects are the training texts of two variable-order Markov models
over a fixed alphabet: counts of every symbol after each context of ``ORDER`` symbols are made in
Spark over all of them, shorter contexts are their sums, and Witten-Bell smoothing backs off from
the longest to the shortest. A third of the training URLs is left out of the counts; the
threshold on the difference of the log-likelihoods per symbol is the one that separates these best.

The models are arrays of ``len(ALPHABET) + 3`` symbols to the power ``ORDER + 1`` cells, 2.6 million
whatever the data. Null URLs and such without ``://`` have an empty host and path and are judged by
the models as the empty text. Without accepted URLs every other one is rejected, without rejected
ones (or both) accepted. Rows, repeats and other columns stay; the added columns replace columns
of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.llm.arrow_text import flat
from fleetspark.llm.shipping import map_batches

#: One digit stands for all; every byte outside is one more symbol, as are the ends of a text.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-_:@=&%~"
SIZE = len(ALPHABET) + 3
ORDER = 3
PAD, END, OTHER = 0, SIZE - 2, SIZE - 1
#: Intervals of the score, from -EDGE to EDGE, in which held-out URLs are counted.
INTERVALS, EDGE = 4096, 8.0
ROWS = 4096

_CODES = np.full(256, OTHER, np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODES[ord(_c)] = _i + 1
_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_CODES[ord("0") : ord("9") + 1] = _CODES[ord("0")]

Rules = list[tuple[str, str, str]]


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``."""
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path")]
    rest = F.coalesce(F.regexp_extract(F.col(f"`{url}`"), "(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select(*kept, host.alias("host"), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"))


def fitting_rule(rules: Rules) -> Column:
    """Name and verdict of the longest of ``rules`` (verdict, host, path) that fits, else null."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("name"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all symbols of the texts with the ``ORDER`` before them, ends included, and their bounds."""
    data, bounds = flat(column)
    n, lengths = len(column), np.diff(bounds)
    # Each text is led by ORDER pads and followed by one end.
    starts = bounds[:-1] + np.arange(n) * (ORDER + 1)
    symbols = np.full(len(data) + n * (ORDER + 1), PAD, np.int64)
    symbols[np.arange(len(data)) + np.repeat((np.arange(n) + 1) * (ORDER + 1) - 1, lengths)] = _CODES[data]
    symbols[starts + ORDER + lengths] = END
    codes = np.zeros(max(0, len(symbols) - ORDER), np.int64)
    for k in range(ORDER + 1):
        codes = codes * SIZE + symbols[k : len(symbols) - ORDER + k]
    keep = np.arange(int((lengths + 1).sum())) + np.repeat(np.arange(n) * ORDER, lengths + 1)
    return codes[keep], np.concatenate(([0], np.cumsum(lengths + 1)))


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    """Log-probability of each symbol after each context, by Witten-Bell back-off."""
    counts = counts.reshape((SIZE,) * (ORDER + 1)).astype(np.float64)
    p = np.full(SIZE, 1 / (SIZE - 1))
    for order in range(ORDER + 1):
        c = counts.sum(axis=tuple(range(ORDER - order)))
        total, kinds = c.sum(axis=-1, keepdims=True), (c > 0).sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (c + kinds * p) / np.maximum(total + kinds, 1), np.broadcast_to(p, c.shape))
    return np.log(p).astype(np.float32).ravel()


class Ratio:
    """Mean log-likelihood difference per symbol, and the least one that is accepted."""

    def __init__(self, table: np.ndarray | None, threshold: float):
        self.table, self.threshold = table, threshold

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.table is None:
            return np.zeros(len(column))
        codes, bounds = grams(column)
        sums = np.concatenate(([0.0], np.cumsum(self.table[codes], dtype=np.float64)))
        return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.diff(bounds)


def _parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def train(texts: DataFrame) -> Ratio:
    """Models and threshold from ``texts`` (text, accepted)."""
    texts = texts.select("text", "accepted").where("accepted is not null")
    held = F.pmod(F.xxhash64("text"), F.lit(3)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts_of(batches):
            accepted = part.column("accepted").to_numpy(zero_copy_only=False)
            codes, bounds = grams(part.column("text"))
            both, n = np.unique(codes * 2 + np.repeat(accepted, np.diff(bounds)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both), pa.array(n)], ["code", "n"])

    counted = map_batches(texts.where(~held), count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(2 * SIZE ** (ORDER + 1), np.int64)
    counts[counted["code"].to_numpy()] = counted["n"].to_numpy()
    rejected, accepted = counts[0::2], counts[1::2]
    if not accepted.any() or not rejected.any():
        return Ratio(None, 0.0 if accepted.any() or not rejected.any() else np.inf)
    ratio = Ratio(log_likelihoods(accepted) - log_likelihoods(rejected), 0.0)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts_of(batches):
            place = np.clip((ratio.scores(part.column("text")) / EDGE + 1) * INTERVALS / 2, 0, INTERVALS - 1).astype(np.int64)
            both, n = np.unique(place * 2 + part.column("accepted").to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both), pa.array(n)], ["place", "n"])

    found = map_batches(texts.where(held), spread, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(2 * INTERVALS)
    seen[found["place"].to_numpy()] = found["n"].to_numpy()
    bad, good = seen[0::2], seen[1::2]
    # Accepting from interval k on: rejected ones below it and accepted ones from it are right.
    right = np.append(0, np.cumsum(bad)) / max(bad.sum(), 1) + np.append(np.cumsum(good[::-1])[::-1], 0) / max(good.sum(), 1)
    best = np.flatnonzero(right >= right.max() - 1e-12)
    middle = best[np.argmin(np.abs(best - best.mean()))]
    return Ratio(ratio.table, float((middle * 2 / INTERVALS - 1) * EDGE))


def judged(pages: DataFrame, rules: Rules, url: str = "url") -> DataFrame:
    """``pages`` with host, path, ``rule`` (or null), ``score`` and ``verdict`` (allow or block)."""
    parts = with_parts(pages, url).withColumn("_rule", fitting_rule(rules))
    texts = parts.select(F.concat("host", "path").alias("text"), (F.col("_rule.verdict") == "allow").alias("accepted"))
    ratio = train(texts)
    added = ("rule", "score", "verdict")
    kept = [f for f in parts.schema.fields if f.name not in (*added, "_rule")]
    schema = T.StructType([*kept, T.StructField("rule", T.StringType()), T.StructField("_listed", T.StringType()), T.StructField("_text", T.StringType())])
    source = parts.select(*[F.col(f"`{f.name}`") for f in kept], F.col("_rule.name").alias("rule"), F.col("_rule.verdict").alias("_listed"), F.concat("host", "path").alias("_text"))
    out = T.StructType([*schema.fields[:-1], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts_of(batches):
            scores = pa.array(ratio.scores(part.column(part.num_columns - 1)), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], scores], out.names)

    scored = map_batches(source, score, out)
    by_score = F.when(F.col("score") >= ratio.threshold, "allow").otherwise("block")
    return scored.withColumn("verdict", F.coalesce("_listed", by_score)).drop("_listed")
