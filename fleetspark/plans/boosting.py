"""Boosted models as a relation: one row for each node of each tree of each model.

All models of a call are trained side by side, on all of their rows. Up to ``ALONE`` rows a model is grown in
a task of its own. More rows are dealt out over tasks that run together (Spark's barrier mode) and tell each other
their sums of each step, which hardly grow with the table, in files of the shared folder; the trees are the same. A task then holds its
share of the rows, about 700 bytes each. A caller may ask for a share of the rows (``boosting_rows``, a
parameter, by default none): those whose hashed keys fall into it. Scores are computed where the rows are; a forest has at most (rounds + 1) * 2 ** (depth + 1) nodes for each model, whatever the data.

Text inputs are numbered in alphabetical order of the values in the training rows; other values are
missing. Missing numbers stay missing (see ``trees``).
"""

from __future__ import annotations

import math
import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import BarrierTaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.functions.staging import shared_folder, stage
from fleetspark.params import FleetParams
from fleetspark.plans.trees import SCALE, Histograms, Scores, Setting, Trees, added, bins_of, grow, growing, shared_cut_points, side_by_side, written

# Executors get the functions of this module with the task and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXT = ("model", "plant_id", "line_id")
#: Rows of a model that one task grows alone, at most, and that each of several tasks gets, at least.
ALONE = 250_000
EACH = 100_000
#: Seconds that a task waits for what another one has to tell.
PATIENCE = 3600
NODES = "name string, tree int, node int, feature int, cut double, value long"


@dataclass(frozen=True)
class Task:
    """One model to train: its label column, the rows it learns from and how it is grown."""

    label: str
    rows: Column
    setting: Setting


@dataclass
class Forest:
    """Trained models: ``nodes`` (name, tree, node, feature, cut, value) and what their inputs are.

    ``feature`` is the place of an input in ``features`` and null in a leaf; ``value`` is a leaf's
    share of the score in units of 1/``SCALE``. A null ``cut`` sends only missing values left.
    """

    nodes: DataFrame
    features: list[str]
    texts: dict[str, list[str]]

    def inputs(self) -> Column:
        return F.array(*[self._number(f) for f in self.features])

    def _number(self, feature: str) -> Column:
        if feature not in self.texts:
            return F.col(feature).cast("double")
        known = F.array(*[F.lit(v) for v in self.texts[feature]]).cast("array<string>")
        return F.nullif(F.array_position(known, F.col(feature)), F.lit(0)).cast("double")

    def trees(self, name: str) -> Trees:
        """The trees of one model as arrays; their size is bounded by the setting."""
        rows = self.nodes.where(F.col("name") == name).toPandas()
        shape = int(rows["tree"].max()) + 1, 2 << int(rows["node"].max()).bit_length()
        out = Trees(np.full(shape, -1), np.zeros(shape), np.zeros(shape, np.int64))
        at = rows["tree"].to_numpy(), rows["node"].to_numpy()
        out.feature[at] = rows["feature"].fillna(-1).to_numpy(np.int64)
        out.cut[at], out.value[at] = rows["cut"].to_numpy(float), rows["value"].fillna(0).to_numpy(np.int64)
        return out

    def with_scores(self, rows: DataFrame, names: dict[str, str]) -> DataFrame:
        """``rows`` with one score column for each model: column by name of the model.

        Only the inputs go to Python and only scores come back. The function counts as not
        deterministic, so that no filter on a score makes Spark score the rows twice.
        """
        models = {column: self.trees(name) for name, column in names.items()}
        k = len(self.features)

        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = Scores(list(models.values()), k)
            for batch in batches:
                made = known.of(_matrix(batch, k))
                yield pa.StructArray.from_arrays([pa.array(s) for s in made], [f"_{i}" for i in range(len(made))])

        kind = T.StructType([T.StructField(f"_{i}", T.DoubleType()) for i in range(len(models))])
        scored = F.arrow_udf(score, kind).asNondeterministic()
        rows = rows.drop(*models)
        out = rows.withColumn("_scores", scored(self.inputs()))
        return out.select(*rows.columns, *[F.col("_scores")[f"_{i}"].alias(c) for i, c in enumerate(models)])


def _matrix(lists: pa.Array, k: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, k)


def _nodes(name: str, trees: Trees) -> pa.Table:
    """The relation of one model; only the places that a row can reach."""
    reached = np.zeros(trees.feature.shape, bool)
    reached[:, 1] = True
    for n in range(1, trees.feature.shape[1] // 2):
        inner = reached[:, n] & (trees.feature[:, n] >= 0)
        reached[:, 2 * n] |= inner
        reached[:, 2 * n + 1] |= inner
    tree, node = np.nonzero(reached)
    feature, cut = trees.feature[tree, node], trees.cut[tree, node]
    leaf = feature < 0
    columns = {
        "name": pa.array([name] * len(tree), pa.string()),
        "tree": pa.array(tree, pa.int32()),
        "node": pa.array(node, pa.int32()),
        "feature": pa.array(feature, pa.int32(), mask=leaf),
        "cut": pa.array(cut, pa.float64(), mask=leaf | np.isnan(cut)),
        "value": pa.array(trees.value[tree, node], pa.int64(), mask=~leaf),
    }
    return pa.table(columns)


def train(rows: DataFrame, features: list[str], tasks: dict[str, Task], p: FleetParams) -> Forest:
    """All models of ``tasks`` by name, from one scan of ``rows``."""
    texts = {f: [] for f in features if f in TEXT}
    if texts:
        found = rows.agg(*[F.sort_array(F.collect_set(f)).alias(f) for f in texts]).first()
        texts = {f: list(found[f]) for f in texts}
    forest = Forest(None, features, texts)

    may = [t.rows & F.col(t.label).isNotNull() for t in tasks.values()]
    pairs = [(i, j) for j in range(len(may)) for i in range(j)]
    found = rows.agg(*[F.count_if(x).alias(str(i)) for i, x in enumerate(may)], *[F.count_if(may[i] != may[j]).alias(f"{i} {j}") for i, j in pairs]).first()
    share = [found[str(i)] for i in range(len(may))]
    learns = may
    if p.boosting_rows is not None:
        hashed = F.pmod(F.xxhash64(*p.keys), F.lit(1 << 32))
        # Rows outside the share go before any input is read: what is left does not grow with the table.
        learns = [x & (hashed < min(1 << 32, (p.boosting_rows << 32) // max(1, n))) for x, n in zip(may, share, strict=True)]
        share = [min(n, p.boosting_rows) for n in share]
    if max(share) <= ALONE:
        forest.nodes = stage(_each_alone(rows, forest, tasks, learns), "forest")
        return forest
    # Models that learn from the same rows are grown together.
    first = [next((i for i in range(j) if not found[f"{i} {j}"]), j) for j in range(len(may))]
    names, grown = list(tasks), []
    for i in dict.fromkeys(first):
        same = {names[j]: tasks[names[j]] for j in range(len(may)) if first[j] == i}
        if share[i]:
            with shared_folder(rows.sparkSession, "told") as folder:
                grown.append(stage(_dealt_out(rows.where(learns[i]), forest, same, share[i], folder), "forest"))
    forest.nodes = reduce(DataFrame.unionByName, grown)
    return forest


def _each_alone(rows: DataFrame, forest: Forest, tasks: dict[str, Task], learns: list[Column]) -> DataFrame:
    """The nodes of all models, each grown in one task."""
    names, settings, k = list(tasks), [t.setting for t in tasks.values()], len(forest.features)
    entries = [F.when(x, F.struct(F.lit(i).alias("_task"), F.col(t.label).cast("double").alias("_y"))) for i, (x, t) in enumerate(zip(learns, tasks.values(), strict=True))]
    taught = rows.where(reduce(lambda a, b: a | b, learns)).select(forest.inputs().alias("_x"), F.explode(F.array_compact(F.array(*entries))).alias("_w"))
    taught = taught.select("_w._task", "_w._y", "_x")

    def fit(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        which = group.column("_task")[0].as_py()
        y = group.column("_y").to_numpy()
        return _nodes(names[which], grow(_matrix(group.column("_x").combine_chunks(), k), y, settings[which]))

    return taught.groupBy("_task").applyInArrow(fit, NODES)


class Told:
    """What tasks that run together tell each other, step by step, as files of a shared folder that pyarrow can open.

    Spark's own ``allGather`` looks for an answer once a second, and models of 300 rounds take 1,500 steps.
    """

    def __init__(self, folder: str, context: BarrierTaskContext):
        self.fs, root = FileSystem.from_uri(folder)
        # Tasks that are run again, as a stage is repeated, do not meet what the first ones told.
        attempt = min(map(int, context.allGather(str(context.taskAttemptId()))))
        self.root, self.me, self.tasks, self.step = f"{root}/{attempt}", context.partitionId(), len(context.getTaskInfos()), 0
        self.fs.create_dir(self.root, recursive=True)

    def all(self, own: bytes) -> list[bytes]:
        """What each task tells in this step."""
        path = lambda step, task: f"{self.root}/{step}-{task}"
        with self.fs.open_output_stream(path(self.step, self.me) + ".part") as out:
            out.write(own)
        self.fs.move(path(self.step, self.me) + ".part", path(self.step, self.me))
        told = [own if i == self.me else self._read(path(self.step, i)) for i in range(self.tasks)]
        if self.step:  # who has told this step has read the one before
            self.fs.delete_file(path(self.step - 1, self.me))
        self.step += 1
        return told

    def _read(self, path: str) -> bytes:
        pause, until = 0.0005, time.monotonic() + PATIENCE
        while time.monotonic() < until:
            try:
                with self.fs.open_input_file(path) as file:
                    return file.readall()
            except FileNotFoundError:
                time.sleep(pause)
                pause = min(2 * pause, 0.02)
        raise TimeoutError(f"nothing was told in {path}")


def _dealt_out(taught: DataFrame, forest: Forest, tasks: dict[str, Task], n: int, folder: str) -> DataFrame:
    """The nodes of models that learn from the same ``n`` rows, grown by tasks that run together; the first one returns them."""
    names, settings, k = list(tasks), [t.setting for t in tasks.values()], len(forest.features)
    parts = max(1, min(taught.sparkSession.sparkContext.defaultParallelism, math.ceil(n / EACH)))
    labels = F.array(*[F.col(t.label).cast("double") for t in tasks.values()])
    dealt = taught.select(forest.inputs().alias("_x"), labels.alias("_y")).repartition(parts)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        told = Told(folder, context)

        def exchange(sums: list[np.ndarray], used: np.ndarray | None = None) -> list[np.ndarray]:
            """``used``: the bins that an input has; those of histograms (all with four axes) are sent."""
            short = [a[..., used] if a.ndim == 4 else a for a in sums]
            totals = added(told.all(written(short)), short)
            for i, a in enumerate(sums):
                if a.ndim == 4:
                    a[..., used] = totals[i]
                    totals[i] = a
            return totals

        read = [(_matrix(b.column("_x"), k), _matrix(b.column("_y"), len(names))) for b in batches]
        x, y = (np.concatenate([np.empty((0, w)), *[r[i] for r in read]]) for i, w in enumerate((k, len(names))))
        del read
        coded = {}
        for s in settings:
            if s.bins not in coded:
                cuts = shared_cut_points(x, s.bins, exchange)
                bins = bins_of(x, cuts, s)
                coded[s.bins] = bins, Histograms(bins, s.bins + 1), cuts
        del x
        for bins in coded:
            of = [i for i, s in enumerate(settings) if s.bins == bins]
            used = np.arange(bins + 1) < np.array([[2 + len(c)] for c in coded[bins][2]])
            models = side_by_side([growing(*coded[bins], y[:, i], settings[i]) for i in of], lambda sums: exchange(sums, used))  # noqa: B023
            if context.partitionId() == 0:
                for i, trees in zip(of, models, strict=True):
                    yield from _nodes(names[i], trees).to_batches()

    return dealt.mapInArrow(fit, NODES, barrier=True)


def scores_by_join(rows: DataFrame, forest: Forest, name: str, keys: list[str]) -> DataFrame:
    """(``keys``, score) by joins of the rows with the tree relation, one level after another.

    The same as ``Forest.with_scores`` from another side: for judging it, and for engines without Python.
    """
    nodes = F.broadcast(forest.nodes.where(F.col("name") == name).drop("name"))
    depth = (forest.nodes.agg(F.max("node")).first()[0] or 1).bit_length() - 1
    at = rows.select(*keys, forest.inputs().alias("_x")).crossJoin(F.broadcast(forest.nodes.where(F.col("name") == name).select("tree").distinct()))
    at = at.withColumn("node", F.lit(1)).join(nodes, ["tree", "node"])
    for _ in range(depth):
        v = F.get("_x", F.coalesce("feature", F.lit(0)))
        right = F.coalesce(~(v.isNull() | (v <= F.col("cut"))), v.isNotNull())
        moved = F.when(F.col("feature").isNull(), F.col("node")).otherwise(2 * F.col("node") + right.cast("int"))
        at = at.withColumn("node", moved).select(*keys, "_x", "tree", "node").join(nodes, ["tree", "node"])
    total = at.groupBy(*keys).agg(F.sum("value").alias("_total"))
    return total.select(*keys, (1 / (1 + F.exp(-F.col("_total") / SCALE))).alias("score"))
