"""Set similarity self-join of word shingles by a count-vector R-tree spread over Spark.

A document is the set of its distinct word shingles, as 64-bit hashes; equal sets are one node.
Two nodes link when (100 + p) * |A and B| >= p * (|A| + |B|), that is Jaccard >= p/100.

The tree. Shingles are hashed into groups and a node is the point of its group counts. The
overlap of two nodes is at most the sum of the smaller count of each group, so the sum of minima
of a point and the upper corner of a box bounds the overlap with everything in the box.

* Upper levels: sizes are cut into classes within which partners lie in the same or the next
  class. For each class at most d shingles can differ, so with d + 1 groups at least one group is
  the same in both: the boxes of this level are degenerate in one coordinate (same class, group
  and content of the group). Where a node's group is empty, its other groups say nothing about
  it, so such nodes enter again under another hash; the last level takes empty groups too. No
  link is lost, whatever the data.
* Lower levels: the points of one upper box are packed into R-tree nodes and searched with the
  bound (``CountTree``). Boxes beyond ``TILE`` points are cut into tiles that meet pairwise. Boxes
  of the same points are searched once. What the bound leaves must also pass a second one: the
  parities of ``PARITIES`` finer groups differ in no more places than shingles are in one set only.
* Survivors leave their first common box only and are verified on their whole sets.

Groups of near copies would make all their pairs. So first, for ``ROUNDS`` rounds, each upper box
offers one of its points (another one each round) to the points not yet connected to it; pairs
pass the bound and verification, and components are merged. The search of the lower levels then
only looks for pairs of different components: no link between them is lost, and components are
exact.

Null and empty texts have the empty set and link with nothing; fewer words than the width are one
shingle. Repeated rows are equal sets. Rows that share an id count as one document. Rows without
an id are left out. Only the two named columns are read, so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions.staging import release, stage
from fleetspark.llm.arrow_text import flat, mix, word_hashes
from fleetspark.llm.components import merge
from fleetspark.llm.shipping import map_batches

#: Groups of the count vectors, points of a leaf, children of a node, points of a tile.
GROUPS = 128
LEAF = 16
FANOUT = 8
TILE = 1024
#: Groups of which a point holds the parity, and boxes it names to tell a pair's first common one.
PARITIES = 4096
FIRST = 16
#: Rounds in which each box offers one point, and hash levels for nodes with empty groups.
ROUNDS = 3
LEVELS = 4
#: Rows of a text batch that are worked on at a time.
ROWS = 256

_NO_BOX = np.int64(2**63 - 1)
_ORDER = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles of a list of word hashes, sorted."""
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - width + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(min(width, len(hashes))):
        rolled = mix(rolled * _ORDER[0] + hashes[k : k + n] + _ORDER[1])
    return np.unique(rolled)


class SizeClasses:
    """Classes of set sizes under a threshold of ``percent``.

    A pair's smaller set lies in class c and its larger one in c or c + 1; at most ``differing``
    shingles are in one of the two only.
    """

    def __init__(self, percent: int):
        self._percent, self._firsts, self._spare = percent, [1], {}

    def of(self, size: int) -> int:
        while self._firsts[-1] <= size:
            self._firsts.append(self._firsts[-1] * 100 // self._percent + 1)
        return int(np.searchsorted(self._firsts, size, "right")) - 1

    def differing(self, c: int) -> int:
        while len(self._firsts) < c + 2:
            self._firsts.append(self._firsts[-1] * 100 // self._percent + 1)
        largest, p = self._firsts[c + 1] - 1, self._percent
        return (largest + largest * 100 // p) * (100 - p) // (100 + p)

    def spare(self, c: int) -> int:
        """Spare groups of the class, by its smallest size."""
        if c not in self._spare:
            self._spare[c] = spare_groups(self._firsts[c], self.differing(c))
        return self._spare[c]


def spare_groups(size: int, differing: int) -> int:
    """Groups to have beyond ``differing`` + 1, so that a set of ``size`` seldom leaves more than these empty.

    None for small sets, where every further group would be empty.
    """
    for spare in range(differing + 2):
        k = differing + 1 + spare
        empty = k * exp(-size / k)
        if spare >= empty + 1.5 * sqrt(empty) or empty < 0.1:
            return spare
    return 0


def boxes(points: np.ndarray, c: int, differing: int, spare: int) -> np.ndarray:
    """The upper boxes of a set in class ``c``: one for each group that is not empty, of every level it enters."""
    k, out = differing + 1 + spare, []
    for level in range(LEVELS):
        salted = mix(points + np.uint64(level * 1_000_003 + 1))
        group = ((salted >> np.uint64(8)) % np.uint64(k)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        names, firsts = np.unique(group[order], return_index=True)
        sums = np.add.reduceat(mix(salted)[order], firsts)
        # More than ``spare`` groups of a pair are the same: not all are empty in a set with this few.
        enough = k - len(names) <= spare
        if level == LEVELS - 1 and not enough:
            full = np.zeros(k, np.uint64)
            full[names] = sums
            names, sums = np.arange(k), full
        place = np.array([c << 8 | level], np.uint64) * _ORDER[0]
        out.append(mix(sums + mix(names.astype(np.uint64) * _ORDER[1] + place)))
        if enough:
            break
    return np.concatenate(out)


def _sets(docs: DataFrame, key: str, text: str, width: int, row, schema: str) -> DataFrame:
    """One row of ``row(set)`` for each row of ``docs``, after its id."""
    fields = pa.schema([("id", pa.int64()), *row.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                hashes, bounds = word_hashes(*flat(part.column(1)), fold_case=True)
                rows = [row.of(shingles(hashes[bounds[i] : bounds[i + 1]], width)) for i in range(part.num_rows)]
                columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), list(fields)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema=fields)

    source = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return map_batches(source, run, f"id long, {schema}")


class _Signature:
    """Size, 128-bit fingerprint and upper boxes; the first ``n_own`` boxes are of the set's own class."""

    fields = (("n_shingles", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("n_own", pa.int32()), ("boxes", pa.list_(pa.int64())))
    schema = "n_shingles long, high long, low long, n_own int, boxes array<long>"

    def __init__(self, percent: int):
        self._classes = SizeClasses(percent)

    def of(self, points: np.ndarray) -> tuple:
        if not len(points):
            return 0, 0, 0, 0, []
        own = self._classes.of(len(points))
        found = []
        for c in (own, own - 1):
            # No shingle may differ: the sets are equal and already one node.
            d = self._classes.differing(c) if c >= 0 else 0
            found.append(boxes(points, c, d, self._classes.spare(c)) if d else np.zeros(0, np.uint64))
        high, low = (mix(points + salt).sum(dtype=np.uint64).view(np.int64) for salt in _ORDER)
        return len(points), int(high), int(low), len(found[0]), np.concatenate(found).view(np.int64)


class _Points:
    """The whole set, its group counts and the parities of its finer groups, 64 in a number."""

    fields = (
        ("n", pa.int64()),
        ("shingles", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int32())),
        ("parities", pa.list_(pa.int64())),
    )
    schema = "n long, shingles array<long>, counts array<int>, parities array<long>"

    def of(self, points: np.ndarray) -> tuple:
        counts = np.bincount((points & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
        finer = np.bincount(((points >> np.uint64(16)) & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
        parities = np.packbits((finer & 1).astype(np.uint8)).view(np.int64)
        return len(points), points.view(np.int64), counts.astype(np.int32), parities


class CountTree:
    """R-tree over count vectors, packed bottom-up in the order of size and leading counts."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((*counts[:, :3].T, sizes))
        self._points, self._sizes = counts[self.order], sizes[self.order]
        self._levels, corners, least, width = [], self._points, self._sizes, LEAF
        while len(corners) > 1:
            starts = np.arange(0, len(corners), width)
            corners, least = np.maximum.reduceat(corners, starts), np.minimum.reduceat(least, starts)
            self._levels.append((corners, least, width))
            width = FANOUT

    def search(self, counts: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) whose summed minima allow a link."""
        queries = np.arange(len(counts))
        nodes = np.zeros(len(counts), np.int64)
        for depth in range(len(self._levels) - 1, -1, -1):
            corners, least, width = self._levels[depth]
            hit = self._allowed(counts, sizes, corners, least, queries, nodes, percent)
            below = len(self._levels[depth - 1][0]) if depth else len(self._points)
            queries, nodes = np.repeat(queries[hit], width), (nodes[hit][:, None] * width + np.arange(width)).ravel()
            inside = nodes < below
            queries, nodes = queries[inside], nodes[inside]
        hit = self._allowed(counts, sizes, self._points, self._sizes, queries, nodes, percent)
        return queries[hit], self.order[nodes[hit]]

    @staticmethod
    def _allowed(counts, sizes, corners, least, queries, nodes, percent) -> np.ndarray:
        allowed = np.zeros(len(queries), bool)
        for at in range(0, len(queries), 8192):
            q, m = queries[at : at + 8192], nodes[at : at + 8192]
            bound = np.minimum(counts[q], corners[m]).sum(axis=1, dtype=np.int64)
            allowed[at : at + 8192] = (100 + percent) * bound >= percent * (sizes[q] + least[m])
        return allowed


def _may_link(parities: tuple[np.ndarray, np.ndarray], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether the places in which the parities differ leave enough for a link; ``sizes`` are sums of both sets."""
    differing = np.bitwise_count((parities[0] ^ parities[1]).view(np.uint64)).sum(axis=1, dtype=np.int64)
    return (100 + percent) * (sizes - differing) >= 2 * percent * sizes


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value in both rows, ``_NO_BOX`` if there is none.

    Rows are the least values of two sets: if they have one in common, the least of the sets' is among them.
    """
    return np.where((a[:, :, None] == b[:, None, :]).any(axis=2), a, _NO_BOX).min(axis=1)


def _search_tiles(percent: int):
    """Pairs of unconnected points of each (box, i, j); rows arrive sorted by these.

    A pair comes from its first common box; from each one if the points' ``first`` have none in common.
    """
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    lists = {"counts": GROUPS, "parities": PARITIES // 64, "first": FIRST}

    def pairs(group: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left = group["tile"] == group["i"]
        right = group["tile"] == group["j"]
        if not left.any() or not right.any():
            return
        counts, sizes, ids, labels = group["counts"], group["n"], group["id"], group["label"]
        tree = CountTree(counts[right], sizes[right])
        q_ids, q_labels, p_ids, p_labels = ids[left], labels[left], ids[right], labels[right]
        queries, points = ({n: group[n][side] for n in ("n", "parities", "first")} for side in (left, right))
        box, same = group["box"][0], group["i"][0] == group["j"][0]
        for at in range(0, int(left.sum()), 256):
            q, p = tree.search(counts[left][at : at + 256], sizes[left][at : at + 256], percent)
            q = q + at
            keep = (q_labels[q] != p_labels[p]) & ((q_ids[q] < p_ids[p]) | (not same))
            q, p = q[keep], p[keep]
            for start in range(0, len(q), 8192):
                x, y = q[start : start + 8192], p[start : start + 8192]
                linked = _may_link((queries["parities"][x], points["parities"][y]), queries["n"][x] + points["n"][y], percent)
                x, y = x[linked], y[linked]
                common = _first_common(queries["first"][x], points["first"][y])
                here = (common == box) | (common == _NO_BOX)
                yield np.minimum(q_ids[x], p_ids[y])[here], np.maximum(q_ids[x], p_ids[y])[here]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in _with_end(batches):
            if batch is not None:
                new = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("box", "i", "j", "tile", "id", "label", "n")}
                new.update({n: batch.column(n).flatten().to_numpy().reshape(-1, w) for n, w in lists.items()})
                held = new if held is None else {n: np.concatenate((held[n], new[n])) for n in new}
            if held is None:
                continue
            change = np.flatnonzero((np.diff(held["box"]) != 0) | (np.diff(held["i"]) != 0) | (np.diff(held["j"]) != 0)) + 1
            bounds = [0, *change.tolist(), len(held["box"])]
            whole = bounds if batch is None else bounds[:-1]  # the last group may go on
            found = [p for s, e in zip(whole, whole[1:], strict=False) for p in pairs({n: v[s:e] for n, v in held.items()})]
            held = {n: v[whole[-1] :] for n, v in held.items()}
            if found:
                a, b = (np.concatenate(side) for side in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=fields)

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from (b for b in batches if b.num_rows)
    yield None


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: first by the summed minima, then by the sets themselves."""
    for end in ("a", "b"):
        own = sets.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("n", "shingles", "counts")])
        pairs = pairs.join(own, end)
    bound = F.aggregate(F.zip_with("counts_a", "counts_b", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    needed = percent * (F.col("n_a") + F.col("n_b"))
    overlap = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return pairs.where(((100 + percent) * bound >= needed) & ((100 + percent) * overlap >= needed)).select("a", "b")


def similar_components(
    docs: DataFrame, percent: int = 80, width: int = 5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs`` with an id.

    ``component_id`` is the least id that can be reached by links of Jaccard >= ``percent``/100.
    """
    signature = _Signature(percent)
    signed = stage(_sets(docs, key, text, width, signature, signature.schema), "signatures")
    same = ["n_shingles", "high", "low"]
    filled = signed.where("n_shingles > 0")

    nodes = filled.groupBy(*same).agg(F.min("id").alias("id"), F.first("n_own").alias("n_own"), F.first("boxes").alias("boxes"))
    entries = nodes.select("id", "n_own", F.posexplode("boxes").alias("at", "box"))
    entries = entries.select("id", "box", (F.col("at") < F.col("n_own")).alias("own"))
    # What a box holds is found and kept in one pass over its entries, which are dealt out once.
    of_box = Window.partitionBy("box")
    shared = {"least": F.min("id").over(of_box), "most": F.max("id").over(of_box), "any_own": F.max("own").over(of_box)}
    entries = stage(entries.withColumns(shared).where("least < most and any_own").select("box", "id"), "boxes")
    named = stage(signed.select("id", *same), "names")
    release(signed)

    points = _Points()
    wanted = entries.select(F.col("id").alias(key)).distinct()
    sets = stage(_sets(docs.select(key, text).join(wanted, key, "left_semi"), key, text, width, points, points.schema), "sets")
    labels = stage(sets.select("id", F.col("id").alias("label")).distinct(), "labels")

    for turn in range(ROUNDS):
        open_entries = _open(entries, labels)
        offered = open_entries.groupBy("box").agg(
            F.min_by(F.struct(F.col("id").alias("b"), F.col("label").alias("b_label")), F.xxhash64("id", F.lit(turn))).alias("offer")
        )
        met = open_entries.join(offered.select("box", "offer.*"), "box").where("label != b_label")
        pairs = met.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
        links = stage(_verified(pairs, sets, percent), "links")
        labels = merge(labels, links)
        release(open_entries, links)

    open_entries = _open(entries, labels)
    pairs = _candidates(open_entries, sets, percent).distinct()
    links = stage(_verified(pairs, sets, percent), "links")
    labels = merge(labels, links)
    release(open_entries, links)

    classes = named.where("n_shingles > 0").groupBy(*same).agg(F.min("id").alias("node"))
    classes = classes.join(labels.select(F.col("id").alias("node"), "label"), "node", "left")
    classes = classes.select(*same, F.coalesce("label", "node").alias("component_id"))
    release(entries, sets)
    found = named.join(classes, same, "left")
    return found.select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def _open(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries, with labels, of boxes that hold more than one component."""
    named = entries.join(labels, "id")
    mixed = named.groupBy("box").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
    return stage(named.join(mixed.select("box"), "box", "left_semi"), "open-boxes")


def _candidates(open_entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of points of different components that share a box and may link by both bounds."""
    held = open_entries.groupBy("box").agg(
        F.count("*").alias("n_held"), *[F.sum(F.xxhash64("id", F.lit(salt)).cast("decimal(20,0)")).alias(f"held_{salt}") for salt in range(2)]
    )
    once = held.groupBy("n_held", "held_0", "held_1").agg(F.min("box").alias("box"))
    once = once.select("box", F.ceil(F.col("n_held") / TILE).cast("int").alias("tiles"))
    kept = stage(open_entries.join(once, "box"), "searched-boxes")
    first = F.slice(F.array_sort(F.collect_list("box")), 1, FIRST)
    points = kept.groupBy("id").agg(F.concat(first, F.array_repeat(F.lit(int(_NO_BOX)), FIRST)).alias("first"))
    points = sets.select("id", "n", "counts", "parities").join(points.select("id", F.slice("first", 1, FIRST).alias("first")), "id")

    tiled = kept.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select("box", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "id", "label")
    tiled = tiled.join(points, "id").repartition("box", "i", "j").sortWithinPartitions("box", "i", "j")
    return map_batches(tiled, _search_tiles(percent), "a long, b long")
