"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; every other text, whatever its label says, is unlabelled.
Features are words and their leading bytes, as 64-bit hashes, that are more frequent among the
positives by ``Settings.least_z`` standard errors (of the square roots of the counts) and make a
text toxic with a chance of ``Settings.least_purity`` or more by the two rates. A linear numpy
classifier over them is trained by the risk

    share * loss+(positives) + max(0, (1 - seen) * loss-(unlabelled) - (share - seen) * loss-(positives))

whose second part is the corrected risk of the unseen negatives: where training drives it below
zero, the step goes back up instead. ``share`` is the share of toxic texts and ``seen`` that of
confirmed ones among all. Chance and risk are those of all texts, confirmed ones included: where
every text is labelled, ``share`` equals ``seen`` and this is plain learning from two classes.

Equal texts are one text for learning, positive if any of its copies is confirmed; shares and counts
are those of distinct texts, so that the model follows from the tables and not from their layout.
Training takes at most ``Settings.positives`` and ``Settings.unlabelled`` texts, those of the
least hash of their least id. Their features are counted by Spark; the driver gets the kept features and
which of them each sample text has. Every text is scored, whole.

Null and empty texts have no features and get the score of the bias alone. Without positives or
without unlabelled texts every score is 0. Rows, repeats and other columns stay; ``score``
replaces a column of that name. Ids and labels that are null are not learned from; a document
with several labels is confirmed if one of them is 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.functions.staging import stage
from fleetspark.llm.arrow_text import flat, word_hashes
from fleetspark.llm.shipping import map_batches

#: Texts of a batch that are worked on at a time, and partitions of the bounded sample.
ROWS = 512
SAMPLE_PARTS = 32


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample, choice of features and optimiser."""

    positives: int = 4_000
    unlabelled: int = 8_000
    leads: tuple[int, ...] = (4, 5, 6)
    least_z: float = 3.2
    least_purity: float = 0.8
    steps: int = 400
    rate: float = 0.05
    decay: float = 1e-5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Weights of the kept features, in the order of their hashes; all others weigh nothing."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    leads: tuple[int, ...]

    def scores(self, column: pa.Array) -> np.ndarray:
        owner, which = kept_features(column, self.features, self.leads)
        return _sigmoid(self.bias + np.bincount(owner, self.weights[which], len(column)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _kinds(column: pa.Array, leads: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and its beginnings (a row for each kind), and the bounds of the texts.

    The kind is part of the hash: a word is not its own beginning.
    """
    hashes, rows = word_hashes(*flat(column), fold_case=True, leads=leads)
    return hashes + np.arange(len(leads) + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15), rows


def all_features(column: pa.Array, leads: tuple[int, ...]) -> list[np.ndarray]:
    """The distinct features of each text."""
    hashes, rows = _kinds(column, leads)
    return [np.unique(hashes[:, a:b]).view(np.int64) for a, b in zip(rows, rows[1:], strict=False)]


def kept_features(column: pa.Array, names: np.ndarray, leads: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, place in ``names``) of the features of each text that are in sorted ``names``, each once."""
    hashes, rows = _kinds(column, leads)
    if not len(names) or not hashes.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    maybe = np.zeros(1 << 20, bool)
    maybe[names >> np.uint64(44)] = True
    kind, word = np.nonzero(maybe[hashes >> np.uint64(44)])
    found = hashes[kind, word]
    at = np.minimum(np.searchsorted(names, found), len(names) - 1)
    sure = names[at] == found
    owner = np.searchsorted(rows, word[sure], "right") - 1
    keys = np.unique(owner * len(names) + at[sure])
    return keys // len(names), keys % len(names)


def fit(names: np.ndarray, rows: list[np.ndarray], positive: np.ndarray, prior: float, settings: Settings, seen: float = 0.0) -> Model:
    """Train on texts given by the places of their features in ``names``; ``positive`` marks the confirmed.

    ``prior`` is the share of toxic texts among all, ``seen`` that of confirmed ones.
    """
    s, n = settings, len(names)
    if not positive.any() or positive.all():
        return Model(np.zeros(0, np.uint64), np.zeros(0), -40.0, s.leads)
    column = np.concatenate(rows) if n else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    share = np.where(positive, 1 / positive.sum(), 1 / (~positive).sum())
    weights, mean, square = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    weights[n] = -2.0  # the bias
    for t in range(1, s.steps + 1):
        z = weights[n] + np.bincount(text, weights[column], len(rows))
        y, as_negative_loss = _sigmoid(z), np.logaddexp(0, z) * share
        # Slopes of the risk of the positives and of the corrected risk of the negatives.
        as_positive = np.where(positive, prior * (y - 1), 0) * share
        as_negative = np.where(positive, (seen - prior) * y, (1 - seen) * y) * share
        risk = (1 - seen) * as_negative_loss[~positive].sum() - (prior - seen) * as_negative_loss[positive].sum()
        slope = as_positive + as_negative if risk >= 0 else -as_negative
        gradient = np.bincount(column, slope[text], n + 1)
        gradient[n] = slope.sum()
        gradient[:n] += s.decay * weights[:n]
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient**2 - square)
        weights -= s.rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return Model(names, weights[:n], float(weights[n]), s.leads)


def train(docs: DataFrame, confirmed: DataFrame, labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from ``docs`` (id, text), the ids of ``confirmed`` toxic texts and of all ``labelled`` ones.

    All three should hold only rows that may be learned from.
    """
    s = settings
    docs = docs.where("id is not null and text is not null").select("id", "text", F.md5("text").alias("_text"))
    marked = docs.select("id", "_text")
    for marks, name in ((confirmed, "_p"), (labelled, "_l")):
        marked = marked.join(marks.where("id is not null").select("id").distinct().withColumn(name, F.lit(1)), "id", "left")
    # Copies would make their words look significant: each text counts once, under its least id, and
    # is confirmed or labelled if any of its copies is.
    counted = marked.groupBy("_text").agg(F.min("id").alias("id"), F.max("_p").alias("_p"), F.max("_l").alias("_l"))
    counted = stage(counted, "distinct-texts")
    first = F.xxhash64("id", F.lit(s.seed))
    n_all, n_confirmed, n_labelled = counted.agg(F.count("*"), F.count("_p"), F.count("_l")).first()
    if not n_confirmed or n_confirmed == n_all:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -40.0, s.leads)
    share = n_confirmed / max(n_labelled, n_confirmed)
    hidden = min(max((share * n_all - n_confirmed) / (n_all - n_confirmed), 0.0), 0.5)
    seen = n_confirmed / n_all
    prior = max(seen + (1 - seen) * hidden, 1e-3)

    chosen = counted.where("_p = 1").orderBy(first, "id").limit(s.positives).unionByName(
        counted.where("_p is null").orderBy(first, "id").limit(s.unlabelled)
    )
    chosen = stage(chosen.select("id", "_text", F.col("_p").isNotNull().alias("positive")), "sample")
    # At most ``positives`` + ``unlabelled`` rows of three columns; rows with equal id and text are one.
    texts = docs.join(F.broadcast(chosen), ["id", "_text"]).drop("_text").dropDuplicates(["id"])
    texts = stage(texts.repartition(SAMPLE_PARTS), "sample-texts")
    n_p, n_u = texts.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    if not n_p or not n_u:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -40.0, s.leads)

    def list_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = pa.array(all_features(part.column("text"), s.leads), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("positive"), found], ["positive", "features"])

    listed = map_batches(texts, list_features, "positive boolean, features array<long>")
    counts = listed.select("positive", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum(F.col("positive").cast("long")).alias("p"), F.count("*").alias("both")
    )
    others = F.col("both") - F.col("p")
    z = 2 * (F.sqrt("p") - F.sqrt(n_p * (others + 1) / n_u))
    rate_p = F.col("p") / n_p
    purity = prior * rate_p / (seen * rate_p + (1 - seen) * (others + 0.5) / n_u)
    kept = counts.where((z >= s.least_z) & (purity >= s.least_purity)).select("feature").toPandas()
    names = np.sort(kept["feature"].to_numpy(np.int64).view(np.uint64))

    def find_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                owner, which = kept_features(part.column("text"), names, s.leads)
                lists = np.split(which, np.searchsorted(owner, np.arange(1, part.num_rows)))
                found = pa.array(lists, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("positive"), found], ["id", "positive", "places"])

    id_type = docs.schema["id"].dataType.simpleString()
    sample = map_batches(texts, find_features, f"id {id_type}, positive boolean, places array<long>").toPandas()
    sample = sample.sort_values("id", kind="stable")
    rows = [np.asarray(r, np.int64) for r in sample["places"]]
    return fit(names, rows, sample["positive"].to_numpy(bool), prior, s, seen)


def with_scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, from 0 to 1, of every whole text."""
    kept = [f for f in docs.schema.fields if f.name != "score"]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                scores = model.scores(part.column(part.schema.get_field_index(text)))
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], [f.name for f in schema])

    return map_batches(docs, run, schema)
