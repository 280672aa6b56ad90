"""Near-duplicate vectors by robust-pruned flat graphs over overlapping cluster shards.

Vectors with equal labels link when their cosine, in double precision, reaches a threshold. Equal
vectors of a label are one node with a number of copies. Nodes go to the shards of their nearest
centroids (``overlap`` of them, fitted on a bounded sample), so shards overlap. In each shard a
flat graph is built by robust pruning, the adjacency lists of a node from all its shards are
united, and every node of a shard is searched in it from the medoid: greedily with a beam first,
then on from every node in range as long as new ones are found. Cosines met on the way are exact.

Shards beyond ``TILE`` nodes are cut into tiles, each with a graph of its own, and each tile is
searched in every tile of its shard. A link found in several shards counts in the first shard that
both ends have. What leaves a task is a number for each node and at most one edge for each node of
the links' components, never the pairs.

The links of a sample of nodes are counted against all nodes as well; the sample grows until
``Settings.audited`` of its nodes have links, all nodes or ``AUDIT_MOST`` are in it. Recall is the mean share
of a node's links that was found, over all sampled nodes with links and, if that is less, over
groups (nodes weighted by one over their links), so that hot groups do not hide small ones. While
it is below ``Settings.recall``, everything is done again with more centroids for each node: one
more up to ``Settings.most_overlap``, then twice as many. When that would cost more than comparing
all nodes of a label in blocks, these are compared. A sample without links tells nothing: then
overlap goes up to ``Settings.most_overlap``, with a warning.

Vectors that are null, zero, or hold null or non-finite components, and such with a null label,
link with nothing; vectors of different length have no cosine and do not link. Rows with a null id
are left out; rows that share an id are separate nodes but one member of a component. An empty
table gives an empty result. Only the three named columns are read.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage
from fleetspark.llm.components import merge
from fleetspark.llm.shipping import map_batches, ship

TILE = 1024
#: Most nodes of the audit, and most of their components; cosines of a block.
AUDIT_MOST, AUDIT_CELLS = 16_384, 1 << 22


@dataclass(frozen=True)
class Settings:
    """Of the clusters (nodes of a shard, most centroids, sample), the graphs, the search and the audit."""

    shard: int = 1024
    centroids: int = 1024
    sample: int = 20_000
    overlap: int = 2
    most_overlap: int = 5
    degree: int = 24
    pool: int = 48
    alpha: float = 1.2
    beam: int = 24
    audited: int = 256
    recall: float = 0.95


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; the first centroids are spread over the sample in its order."""
    centroids = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centroids)
    return centroids


def build_graph(x: np.ndarray, degree: int, pool: int, alpha: float) -> tuple[np.ndarray, int]:
    """Adjacency lists (-1 where short) of unit vectors by robust pruning, and the medoid.

    The pool of a node holds its nearest nodes, some random ones and the medoid; reverse edges join
    the pool for a second pass, and nodes that the medoid does not reach are hooked on.
    """
    n = len(x)
    medoid = int((x @ x.mean(axis=0)).argmax())
    if n == 1:
        return np.full((1, 1), -1), 0
    near = 1.0 - x @ x.T
    np.fill_diagonal(near, np.inf)
    width = min(pool, n - 1)
    random = np.random.default_rng(n).integers(0, n, (n, 16))
    nearest = np.argpartition(near, width - 1, axis=1)[:, :width]
    edges = _prune(near, np.hstack((nearest, random, np.full((n, 1), medoid))), degree, alpha)
    rows, columns = np.nonzero(edges >= 0)
    to, back = edges[rows, columns], rows
    order = np.lexsort((near[to, back], to))
    to, back = to[order], back[order]
    place = np.arange(len(to)) - np.searchsorted(to, to)
    reverse = np.full((n, pool), -1)
    some = place < pool
    reverse[to[some], place[some]] = back[some]
    edges = _prune(near, np.hstack((edges, reverse)), degree, alpha)
    return _reachable(near, edges, medoid), medoid


def _prune(near: np.ndarray, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """From each pool take the nearest node, drop what is nearer to it (by ``alpha``), and again."""
    n = len(near)
    own = np.arange(n)[:, None]
    distance = np.where(pool >= 0, near[own, pool], np.inf)
    out = np.full((n, degree), -1)
    rows = np.arange(n)
    for k in range(degree):
        best = distance.argmin(axis=1)
        chosen = np.where(np.isfinite(distance[rows, best]), pool[rows, best], -1)
        if (chosen < 0).all():
            break
        out[:, k] = chosen
        between = near[np.maximum(chosen, 0)[:, None], np.maximum(pool, 0)]
        gone = (pool == chosen[:, None]) | (alpha * between <= distance)
        distance = np.where(gone | (chosen < 0)[:, None], np.inf, distance)
    return out


def _reachable(near: np.ndarray, edges: np.ndarray, medoid: int) -> np.ndarray:
    n = len(near)
    while True:
        seen = np.zeros(n, bool)
        seen[medoid] = True
        front = np.array([medoid])
        while len(front):
            found = np.unique(edges[front])
            front = found[(found >= 0) & ~seen[np.maximum(found, 0)]]
            seen[front] = True
        if seen.all():
            return edges
        lost = np.flatnonzero(~seen)
        # Each lost node that is nearest to a node within reach among all lost ones is hooked onto it.
        inside = np.flatnonzero(seen)
        to = inside[near[np.ix_(lost, inside)].argmin(axis=1)]
        first = near[lost, to].argmin()
        extra = np.full((n, 1), -1)
        extra[to[first], 0] = lost[first]
        full = (edges[to[first]] >= 0).all()
        if full:
            edges = np.hstack((edges, extra))
        else:
            edges[to[first], np.flatnonzero(edges[to[first]] < 0)[0]] = lost[first]


def search(x: np.ndarray, edges: np.ndarray, medoid: int, queries: np.ndarray, threshold: float, beam: int) -> np.ndarray:
    """Which nodes (columns) are in range of each query (row): greedy with a beam, then range-expanding."""
    n = len(x)
    known = np.full((len(queries), n), -np.inf)
    known[:, medoid] = queries @ x[medoid]
    expanded = np.zeros((len(queries), n), bool)
    active = np.arange(len(queries))
    while len(active):
        values = np.where(expanded[active], -np.inf, known[active])
        node = values.argmax(axis=1)
        value = values[np.arange(len(active)), node]
        # The beam: as good as the best ``beam`` met so far. In range: always.
        if n > beam:
            edge = np.partition(known[active], n - beam, axis=1)[:, n - beam]
        else:
            edge = np.full(len(active), -np.inf)
        going = np.isfinite(value) & ((value >= edge) | (value >= threshold))
        active, node = active[going], node[going]
        if not len(active):
            break
        expanded[active, node] = True
        next_to = edges[node]
        valid = next_to >= 0
        rows, columns = np.nonzero(valid & ~np.isfinite(known[active[:, None], np.maximum(next_to, 0)]))
        who, what = active[rows], next_to[rows, columns]
        known[who, what] = np.einsum("ij,ij->i", queries[who], x[what])
    return known >= threshold


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def near_duplicates(
    vectors: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()
) -> DataFrame:
    """(id, n_links, component_id) of every row of ``vectors`` with an id."""
    s = settings
    rows = vectors.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("x")
    )
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("x", lambda v: v != 0), F.lit(False))
    prints = [F.xxhash64("label", "x").alias("high"), F.xxhash64(F.lit(1), "x", "label").alias("low")]
    rows = rows.withColumn("usable", usable)
    nodes = stage(
        rows.where("usable").groupBy(*prints).agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("x").alias("x"))
        # Scaled by the largest part first, so that squares neither overflow nor vanish.
        .withColumn("top", F.array_max(F.transform("x", F.abs)))
        .withColumn("x", F.transform("x", lambda v: v / F.col("top")))
        .withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda t, v: t + v * v)))
        .withColumn("x", F.transform("x", lambda v: v / F.col("norm")))
        .select("high", "low", "copies", F.concat_ws(":", F.size("x"), "label").alias("label"), "x", F.xxhash64("high", "low").alias("id"), "node"),
        "nodes",
    )
    n_nodes, n_labels = nodes.agg(F.count("*"), F.count_distinct("label")).first()
    k = min(s.centroids, max(1, round(n_nodes / max(1, n_labels) / s.shard)))
    sample = nodes.orderBy("id").limit(s.sample).select("x").toPandas()["x"] if k > 1 else []
    length = np.bincount([len(v) for v in sample]).argmax() if len(sample) else 0
    sample = np.array([v for v in sample if len(v) == length], np.float64)
    centroids = fit_centroids(sample, min(k, len(sample))) if len(sample) else np.zeros((1, max(1, length)))

    true = _true_links(nodes, n_nodes, threshold, s)
    overlap = min(s.overlap, len(centroids))
    while True:
        counts, edges = _links(nodes, centroids, overlap, threshold, s)
        if len(true) and _recall(true, counts) >= s.recall:
            break
        if not len(true) and (overlap >= min(s.most_overlap, len(centroids)) or n_nodes <= AUDIT_MOST):
            if n_nodes > AUDIT_MOST:
                warnings.warn("no audited vector has a link: recall is not known", stacklevel=2)
            break
        overlap += 1 if overlap < s.most_overlap else overlap
        # Shards of so much overlap have more pairs of tiles than the whole label.
        if len(true) and overlap**2 > len(centroids):
            counts, edges = _links(nodes, np.zeros((1, centroids.shape[1])), 1, threshold, s, exact=True)
            break

    labels = merge(nodes.select("id", F.col("id").alias("label")), edges)
    least = labels.join(nodes.select("id", "node"), "id").groupBy("label").agg(F.min("node").alias("component"))
    found = nodes.select("id", "high", "low", "copies").join(labels, "id").join(least, "label")
    found = found.join(counts, "id", "left").select(
        "high", "low", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component"
    )
    keyed = rows.select("id", *[F.when(F.col("usable"), p).alias(n) for p, n in zip(prints, ("high", "low"), strict=True)])
    out = keyed.join(found, ["high", "low"], "left")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))


def _links(nodes: DataFrame, centroids: np.ndarray, overlap: int, threshold: float, s: Settings, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """Links of each node (id, n), counting copies, and edges (a, b) that connect what is linked.

    ``exact`` compares all nodes of each pair of tiles instead of searching graphs.
    """
    ship(nodes.sparkSession)

    def assign(batches):
        for batch in batches:
            x = batch.column("x")
            lengths = np.diff(x.offsets.to_numpy())
            found = np.zeros((batch.num_rows, overlap), np.int32)
            whole = np.flatnonzero(lengths == centroids.shape[1])
            if len(whole) and len(centroids) > 1:
                sims = _matrix(x.take(pa.array(whole))) @ centroids.T
                found[whole] = np.sort(np.argpartition(-sims, overlap - 1, axis=1)[:, :overlap], axis=1)
            shards = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), overlap).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "label", "copies", "x")], shards], ["id", "label", "copies", "x", "shards"])

    placed = map_batches(nodes.select("id", "label", "copies", "x"), assign, "id long, label string, copies long, x array<double>, shards array<int>")
    members = placed.withColumn("shard", F.explode(F.array_distinct("shards")))
    sizes = members.groupBy("label", "shard").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    members = members.join(sizes, ["label", "shard"]).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    members = stage(members, "members")

    def build(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        edges, medoid = build_graph(_matrix(table["x"]), s.degree, s.pool, s.alpha)
        own, place = np.nonzero(edges >= 0)
        at = np.append(own, medoid)
        to = np.append(edges[own, place], medoid)  # the medoid is kept as an edge to itself
        return pa.table({"id": ids[at], "to": ids[to], "label": [table["label"][0].as_py()] * len(at)})

    built = members.select("label", "shard", "tile", "id", "x").groupBy("label", "shard", "tile").applyInArrow(build, "id long, to long, label string")
    # Each node has at most ``overlap`` lists of ``degree`` and a few more.
    adjacency = built.groupBy("id").agg(F.collect_set("to").alias("near"))

    def walk(table: pa.Table, ids: np.ndarray, x: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        near = table["near"].combine_chunks().take(pa.array(right))
        owner = np.repeat(np.arange(len(right)), np.diff(near.offsets.to_numpy()))
        order = np.argsort(ids[right])
        named = near.flatten().to_numpy()
        at = np.minimum(np.searchsorted(ids[right], named, sorter=order), len(right) - 1)
        to, present = order[at], ids[right][order[at]] == named
        medoids = owner[present & (to == owner)]
        owner, to = owner[present], to[present]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        edges = np.full((len(right), int(place.max()) + 1 if len(place) else 1), -1)
        edges[owner, place] = to
        points = x[right]
        start = int(medoids[(points[medoids] @ points.mean(axis=0)).argmax()]) if len(medoids) else 0
        hits = np.zeros((len(left), len(right)), bool)
        for q in range(0, len(left), 256):
            hits[q : q + 256] = search(points, edges, start, x[left[q : q + 256]], threshold, s.beam)
        return hits

    def look(table: pa.Table) -> pa.Table:
        tile = table["tile"].to_numpy()
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        none = pa.table({"id": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "to": pa.array([], pa.int64())})
        if not len(left) or not len(right):
            return none
        ids, copies, x = table["id"].to_numpy(), table["copies"].to_numpy(), _matrix(table["x"])
        shards, shard = _matrix(table["shards"]), table["shard"][0].as_py()
        hits = x[left] @ x[right].T >= threshold if exact else walk(table, ids, x, left, right)
        if i == j:
            hits |= hits.T
            np.fill_diagonal(hits, False)
        a, b = np.nonzero(hits)
        # The first shard of both ends counts the link.
        common = np.where((shards[left][a][:, :, None] == shards[right][b][:, None, :]), shards[left][a][:, :, None], np.iinfo(np.int32).max)
        first = common.reshape(len(a), -1).min(axis=1) == shard if len(a) else np.zeros(0, bool)
        n = np.bincount(left[a[first]], copies[right[b[first]]], len(ids))
        if i != j:
            n += np.bincount(right[b[first]], copies[left[a[first]]], len(ids))
        root = np.arange(len(ids))
        u, v = left[a], right[b]
        while True:
            before = root.copy()
            np.minimum.at(root, u, root[v])
            np.minimum.at(root, v, root[u])
            root = root[root]
            if (root == before).all():
                break
        some = np.flatnonzero((n > 0) | (root != np.arange(len(ids))))
        return pa.table({"id": ids[some], "n": n[some].astype(np.int64), "to": ids[root[some]]})

    near = members.withColumn("near", F.array().cast("array<bigint>")) if exact else members.join(adjacency, "id")
    tiled = near.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select("label", "shard", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "id", "copies", "x", "shards", "near")
    found = stage(tiled.groupBy("label", "shard", "i", "j").applyInArrow(look, "id long, n long, to long"), "found")
    return found.groupBy("id").agg(F.sum("n").alias("n")), found.where("id != to").select(F.col("id").alias("a"), F.col("to").alias("b")).distinct()


def _true_links(nodes: DataFrame, n_nodes: int, threshold: float, s: Settings) -> pd.DataFrame:
    """(id, true) of audited nodes that have links, those of the least hash; all nodes are met in blocks."""
    # The audit's own vectors are on the driver and in each task.
    length = nodes.agg(F.max(F.size("x"))).first()[0] or 1
    most = max(s.audited, min(AUDIT_MOST, AUDIT_CELLS // length))
    size = min(8 * s.audited, most)
    while True:
        audited = nodes.orderBy(F.xxhash64("id")).limit(size).select("id", "label", "x").toPandas()
        groups = {name: (g["id"].to_numpy(np.int64), np.array(g["x"].tolist(), np.float64)) for name, g in audited.groupby("label")}

        def compare(batches, groups=groups):
            totals = {name: np.zeros(len(own), np.int64) for name, (own, _) in groups.items()}
            for batch in batches:
                label, ids, copies = np.array(batch.column("label").to_pylist()), batch.column("id").to_numpy(), batch.column("copies").to_numpy()
                for name in set(label) & groups.keys():
                    own, x = groups[name]
                    rows, step = np.flatnonzero(label == name), max(1, AUDIT_CELLS // len(own))
                    for at in range(0, len(rows), step):
                        part = rows[at : at + step]
                        near = (_matrix(batch.column("x").take(pa.array(part))) @ x.T >= threshold) & (ids[part][:, None] != own[None, :])
                        totals[name] += copies[part] @ near
            for name, n in totals.items():
                some = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(groups[name][0][some]), pa.array(n[some])], ["id", "true"])

        found = map_batches(nodes.select("id", "label", "copies", "x"), compare, "id long, true long")
        true = found.groupBy("id").agg(F.sum("true").alias("true")).toPandas()
        if len(true) >= s.audited or size >= min(n_nodes, most):
            return true
        size = min(2 * size, most)


def _recall(true: pd.DataFrame, counts: DataFrame) -> float:
    """Mean share of the links of the audited nodes that were found: over nodes, or over groups if that is less."""
    audited = counts.sparkSession.createDataFrame(pa.Table.from_pandas(true[["id"]], preserve_index=False))
    got = counts.join(F.broadcast(audited), "id").toPandas().set_index("id")["n"]
    n = got.reindex(true["id"]).fillna(0).to_numpy(np.float64)
    links = true["true"].to_numpy(np.float64)
    share = np.minimum(n, links) / links
    return float(min(share.mean(), np.average(share, weights=1 / links)))
