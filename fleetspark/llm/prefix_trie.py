"""Prefix trie of conversations by truncation peeling.

A conversation is its list of turns (role, text). ``turn_lists`` brings each into one row of 16-byte
digests and text sizes; ``sequences`` turns these into path keys: the key of depth d is the sum, in two
lanes of 64 bits, of the mixed digests of the first d turns, each salted with its place. A node is a
depth and a path.

``peel`` starts at the greatest depth. At each depth the conversations that end there meet the nodes
that survived from below, equal paths become one node, its figures are complete at once, and its last
turn is stripped, so that it survives to the depth above. Equal conversations are one row from the
start, and all grouping is by sums that combine on the map side, so a path that a third of all
conversations share is no hot key. The driver sees the greatest depth and one yes or no for a stretch
of depths.

Long stretches that one row has for itself need no regrouping: before a stretch beyond ``SHALLOW`` is
peeled, rows that share its upper end with no other are stripped down to it in one go, and each of
their nodes is written out. Only the rest is halved and peeled further, so jobs grow with the depths
at which conversations meet and not with the longest conversation. What is held of one conversation
in one row is 36 bytes a turn, never its texts.

Defined results: turns are ordered by turn (null first), ties by role and text; null role or text is
empty; repeated rows are turns of their own; rows without a conversation id are left out; an empty
table has no nodes, not even a root; texts of any length are read whole. Other columns are not looked at and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions.staging import release, stage
from fleetspark.llm.arrow_text import mix
from fleetspark.llm.shipping import map_batches

#: Down to this depth every stretch is peeled depth by depth without a look for lone rows.
SHALLOW = 16
#: Characters of joined ids that travel in one row.
CHUNK = 1 << 16
_SALT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_PATH = ("depth", "high", "low", "sizes")
_NODE = ("depth", "high_key", "low_key", "high_up", "low_up", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def turn_lists(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turns array<struct<at, digest, size>>) of every conversation, in order."""
    named = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    # The size of the role keeps (role, text) apart whatever they hold.
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    placed = named.select(
        "conv_id",
        F.struct(
            F.row_number().over(order).alias("at"), digest.alias("digest"), F.octet_length("text").cast("long").alias("size")
        ).alias("one"),
    )
    return placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))


def sequences(lists: DataFrame) -> DataFrame:
    """(conv_id, depth, high, low, sizes): per turn the two halves of the path key and the bytes so far."""
    listed = lists.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes = batch.column(1), batch.column(2).flatten().to_numpy(zero_copy_only=False)
            depth = np.fromiter((0 if n is None else n for n in digests.value_lengths().to_pylist()), np.int64, len(digests))
            bounds = np.concatenate(([0], np.cumsum(depth)))
            flat = digests.flatten().cast(pa.binary(16))
            lanes = np.frombuffer(flat.buffers()[1] or b"", np.uint64)[2 * flat.offset : 2 * (flat.offset + len(flat))].reshape(-1, 2)
            starts = np.repeat(bounds[:-1], depth)
            place = (np.arange(bounds[-1]) - starts).astype(np.uint64)

            def so_far(values: np.ndarray) -> pa.ListArray:
                total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)))
                return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array((total[1:] - total[starts]).view(np.int64)))

            keys = [so_far(mix(lanes[:, k] ^ mix(place * _SALT[k] + _SALT[1 - k]))) for k in (0, 1)]
            columns = [batch.column(0), pa.array(depth), *keys, so_far(sizes.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "depth", "high", "low", "sizes"])

    return map_batches(listed, run, "conv_id long, depth long, high array<long>, low array<long>, sizes array<long>")


def _key(column: str, depth) -> F.Column:
    """The value of a path array at ``depth``; the root has 0."""
    return F.coalesce(F.get(column, depth - 1), F.lit(0).cast("long"))


def _node(depth, n_children, n_leaves, saved) -> list[F.Column]:
    keys = [_key(c, d).alias(f"{c}_{name}") for name, d in (("key", depth), ("up", depth - 1)) for c in ("high", "low")]
    return [
        depth.alias("depth"), *keys, F.col("conv_id"), F.col("n_convs"),
        n_children.alias("n_children"), n_leaves.alias("n_leaves"), saved.alias("saved_tokens"),
    ]


def _cut(depth, n_leaves, saved) -> list[F.Column]:
    """A row that waits at ``depth`` for its parent's other children, as one child."""
    arrays = [F.slice(c, 1, depth.cast("int")).alias(c) for c in ("high", "low", "sizes")]
    return [
        depth.cast("long").alias("depth"), *arrays, F.col("conv_id"), F.col("n_convs"),
        F.lit(1).cast("long").alias("n_children"), n_leaves.alias("n_leaves"), saved.alias("saved_tokens"),
    ]


class _Peeling:
    def __init__(self):
        self.nodes: list[DataFrame] = []
        self.tables: list[DataFrame] = []

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(stage(df, name))
        return self.tables[-1]

    def level(self, rows: DataFrame) -> DataFrame:
        """Merge what waits at one depth, write its nodes, and strip the last turn."""
        sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
        merged = rows.groupBy(*_PATH).agg(F.min("conv_id").alias("conv_id"), *sums)
        depth, own = F.col("depth"), _key("sizes", F.col("depth")) - _key("sizes", F.col("depth") - 1)
        merged = merged.withColumns(
            {
                "n_leaves": F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")),
                "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * own,
            }
        )
        merged = self._stage(merged, "trie-level")
        self.nodes.append(merged.select(*_node(depth, F.col("n_children"), F.col("n_leaves"), F.col("saved_tokens"))))
        return merged.select(*_cut(depth - 1, F.col("n_leaves"), F.col("saved_tokens")))

    def lone(self, rows: DataFrame, least: int) -> DataFrame:
        """Strip rows that meet no other down to depth ``least``, writing all nodes on the way."""
        leaves, depth = F.greatest("n_leaves", F.lit(1)), F.col("depth")

        def saved(down_to) -> F.Column:
            return F.col("saved_tokens") + (F.col("n_convs") - 1) * (_key("sizes", depth) - _key("sizes", down_to - 1))

        every = rows.withColumn("_at", F.explode(F.sequence(F.lit(least + 1).cast("long"), depth)))
        at = F.col("_at")
        children = F.when(at == depth, F.col("n_children")).otherwise(F.lit(1).cast("long"))
        self.nodes.append(every.select(*_node(at, children, leaves, saved(at))))
        return rows.select(*_cut(F.lit(least), leaves, saved(F.lit(least + 1))))

    def peel(self, rows: DataFrame, least: int, most: int) -> DataFrame:
        """Peel all ``rows``, of depths ``least`` + 1 to ``most``, down to ``least``."""
        if most - least == 1:
            return self.level(rows)
        done = None
        if most > SHALLOW and least:
            ends = [F.slice(c, 1, least).alias(f"_{c}") for c in ("high", "low")]
            cut = rows.select("*", *ends)
            met = cut.groupBy("_high", "_low").agg((F.count("*") == 1).alias("_alone"))
            split = self._stage(cut.join(met, ["_high", "_low"]).drop("_high", "_low"), "trie-stretch")
            done = self.lone(split.where("_alone").drop("_alone"), least)
            rows = split.where("not _alone").drop("_alone")
            if rows.isEmpty():
                return done
        middle = (least + most) // 2
        below = self.peel(rows.where(F.col("depth") > middle), middle, most)
        above = self.peel(below.unionByName(rows.where(F.col("depth") <= middle)), least, middle)
        return above if done is None else above.unionByName(done)


def joined_ids_sha256(ids: DataFrame, by: list[str], value: str) -> DataFrame:
    """(``by``, ends_sha256): SHA-256 of each group's ids, ascending and joined by commas.

    A digest is made from the first byte to the last, but its text is not: ranges of the ids join
    theirs to pieces of ``CHUNK`` characters first, and only the pieces of a group meet, one at a time.
    """
    keyed = ids.select(*[F.col(c).cast("long") for c in by], F.col(value).cast("long").alias("_first"))
    keyed = keyed.repartitionByRange(*by, "_first").sortWithinPartitions(*by, "_first")
    names = [*by, "_first", "_text"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # key, first id, texts, characters
        for batch in batches:
            out = []
            for *key, one in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held[0] != key or held[3] > CHUNK:
                    if held:
                        out.append((*held[0], held[1], ",".join(held[2])))
                    held = (key, one, [], 0)
                text = str(one)
                held[2].append(text)
                held = (*held[:3], held[3] + len(text) + 1)
            if out:
                yield _batch(out, names)
        if held:
            yield _batch([(*held[0], held[1], ",".join(held[2]))], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for *own, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own == key:
                    state.update(b",")
                else:
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                state.update(text.encode())
            if out:
                yield _batch(out, [*by, "ends_sha256"])
        if state:
            yield _batch([(*key, state.hexdigest())], [*by, "ends_sha256"])

    longs = "".join(f"{c} long, " for c in by)
    pieces = map_batches(keyed, join, f"{longs}_first long, _text string")
    pieces = pieces.repartition(*by).sortWithinPartitions(*by, "_first")
    return map_batches(pieces, digest, f"{longs}ends_sha256 string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.string() if n in ("_text", "ends_sha256") else pa.int64() for n in names]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def prefix_trie(lists: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``lists`` (conv_id, turns), as ``turn_lists`` gives them.

    ``conv_id`` is the smallest member and ``parent_conv_id`` the parent's (null for the root).
    Conversations without turns are members of the root. ``conv_id`` of ``lists`` must be unique.
    """
    long = F.lit(0).cast("long")
    all_of = stage(sequences(lists), "trie-paths")
    waiting = all_of.groupBy(*_PATH).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    waiting = waiting.withColumns({"n_children": long, "n_leaves": long, "saved_tokens": long})
    waiting = stage(waiting.sortWithinPartitions("depth"), "trie-ends")
    deepest = waiting.agg(F.max("depth")).first()[0] or 0

    peeling = _Peeling()
    rows = waiting.where("depth > 0")
    below = peeling.peel(rows, 0, deepest) if deepest else rows
    peeling.level(below.unionByName(waiting.where("depth = 0")))
    nodes = peeling.nodes[0]
    for more in peeling.nodes[1:]:
        nodes = nodes.unionByName(more)
    nodes = stage(nodes.select(*_NODE), "trie-nodes")

    last = all_of.select("depth", _key("high", F.col("depth")).alias("high_key"), _key("low", F.col("depth")).alias("low_key"), "conv_id")
    key = ["depth", "high_key", "low_key"]
    ends = stage(joined_ids_sha256(last, key, "conv_id"), "trie-members")
    release(all_of, waiting, *peeling.tables)

    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("high_key").alias("high_up"), F.col("low_key").alias("low_up"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    found = nodes.join(parents, ["depth", "high_up", "low_up"], "left").join(ends, key, "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )
