"""Boosted trees in whole numbers: numpy kernels that run inside Spark tasks.

Scores, gradients and leaf values are multiples of 1/``SCALE``, so all sums are exact: a model depends
neither on the order of the rows nor on how they are spread, and a repeated task gives the same
trees. Rows may lie in several tasks: ``growing`` knows of the other ones' only their sums. One tree after another is grown level by level from histograms of cut values; a split must
leave ``least`` rows on both sides and takes the greatest gain, of equal ones the first input and
the lowest cut. A missing value is below every cut.

A tree is an array over heap places: 1 is the root, the children of n are 2n (value <= cut, or
missing) and 2n + 1.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Generator
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

# Executors get these functions with the task and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1 << 20


@dataclass(frozen=True)
class Setting:
    """How a model is grown; ``least`` rows in a leaf, ``bins`` - 1 cuts of an input at most."""

    rate: float = 0.1
    depth: int = 4
    rounds: int = 300
    l2: float = 1.0
    least: int = 20
    bins: int = 64


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Values at evenly spread ranks, each once."""
    known = np.sort(values[~np.isnan(values)])
    if not len(known):
        return known
    return np.unique(known[np.arange(1, bins) * len(known) // bins])


def whole(x: np.ndarray) -> np.ndarray:
    return np.floor(x + 0.5)


def chance(score: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-score / SCALE))


def first_score(positives: int, rows: int) -> int:
    return math.floor(math.log((2 * positives + 1) / (2 * (rows - positives) + 1)) * SCALE + 0.5)


#: Adds up what each task has: arrays of whole numbers, of the same shapes in every task.
Exchange = Callable[[list[np.ndarray]], list[np.ndarray]]


def _ordered(bits: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles with these ``bits``, and back."""
    return bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))


def shared_cut_points(x: np.ndarray, bins: int, exchange: Exchange) -> list[np.ndarray]:
    """``cut_points`` of each input over the rows of all tasks, exact: all ranks are bisected side by side."""
    keys = [np.sort(_ordered((c[~np.isnan(c)] + 0.0).view(np.int64))) for c in x.T]
    known = exchange([np.array([[len(k)] for k in keys], float)])[0].astype(np.int64)
    ranks = np.arange(1, bins) * known // bins + 1
    low, high = (np.full(ranks.shape, end, np.int64) for end in (-(1 << 63), (1 << 63) - 1))
    for _ in range(64):
        middle = (low >> 1) + (high >> 1) + (low & high & 1)
        own = np.array([np.searchsorted(k, m, "right") for k, m in zip(keys, middle, strict=True)], float)
        enough = exchange([own])[0] >= ranks
        low, high = np.where(enough, low, np.minimum(middle, high - 1) + 1), np.where(enough, middle, high)
    return [np.unique(_ordered(v).view(float)) if n else np.empty(0) for v, n in zip(low, known[:, 0], strict=True)]


def written(sums: list[np.ndarray]) -> bytes:
    """Whole numbers in short: of each row of each array the lowest bytes that hold all of it."""
    out = []
    for row in (r for a in sums for r in a.reshape(len(a), -1)):
        whole_row = row.astype("<i8")
        size = (max(int(whole_row.max(initial=0)), -1 - int(whole_row.min(initial=0))).bit_length() + 8) // 8
        out += [bytes([size]), whole_row.view(np.uint8).reshape(-1, 8)[:, :size].tobytes()]
    return b"".join(out)


def added(told: list[bytes], like: list[np.ndarray]) -> list[np.ndarray]:
    """The sums of what has been ``written`` of arrays of these shapes."""
    totals = [np.zeros((len(a), a.size // len(a)), np.int64) for a in like]
    for raw in told:
        at = 0
        for total in (r for t in totals for r in t):
            size, at = raw[at], at + 1
            digits = np.zeros((len(total), 8), np.uint8)
            digits[:, :size] = np.frombuffer(raw, np.uint8, len(total) * size, at).reshape(-1, size)
            shift = 64 - 8 * size
            total += digits.view("<i8")[:, 0] << shift >> shift
            at += len(total) * size
    return [t.reshape(a.shape).astype(float) for t, a in zip(totals, like, strict=True)]


@dataclass
class Trees:
    """``feature`` (-1: leaf), ``cut`` (NaN: only missing values go left) and ``value`` of each tree and heap place."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return Scores([self], x.shape[1]).of(x)[0]

    def cuts(self, inputs: int) -> list[np.ndarray]:
        """The cuts of each input, ascending, each once."""
        real = (self.feature >= 0) & ~np.isnan(self.cut)
        return [np.unique(self.cut[real & (self.feature == j)]) for j in range(inputs)]


class Scores:
    """Scores of the same rows by several models.

    Inputs are compared with the cuts of all models once; by its code alone a row then goes left or
    right of a node. Leaves are chosen from the lowest level up, for all rows of a node at once, on
    places of one byte.
    """

    def __init__(self, models: list[Trees], inputs: int):
        own = [m.cuts(inputs) for m in models]
        self.cuts = [np.unique(np.concatenate(c)) for c in zip(*own, strict=True)]
        most = max(map(len, self.cuts), default=0)
        self.kind = np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32
        self.models = [self._compiled(m) for m in models]

    def _compiled(self, m: Trees) -> list[tuple]:
        """(root, values, type of a place) of each tree; a node is a leaf's place or (input, highest code to the left, both children)."""
        above = np.zeros(m.feature.shape, np.int64)
        for j, known in enumerate(self.cuts):
            here = (m.feature == j) & ~np.isnan(m.cut)
            above[here] = 1 + np.searchsorted(known, m.cut[here])
        small = np.uint8 if m.feature.shape[1] <= 256 else np.int64

        def node(feature: list[int], codes: list[int], n: int) -> tuple | int:
            if feature[n] < 0:
                return n
            return feature[n], self.kind(codes[n]), node(feature, codes, 2 * n), node(feature, codes, 2 * n + 1)

        return [(node(f.tolist(), a.tolist(), 1), v, small) for f, a, v in zip(m.feature, above, m.value, strict=True)]

    def of(self, x: np.ndarray, rows: int = 16384) -> list[np.ndarray]:
        """Scores of the rows ``x`` by each model."""
        out = [np.empty(len(x)) for _ in self.models]
        for at in range(0, len(x), rows):
            part = x[at : at + rows]
            codes = [coded(part[:, j], c).astype(self.kind) for j, c in enumerate(self.cuts)]
            for trees, made in zip(self.models, out, strict=True):
                total = np.zeros(len(part), np.int64)
                for root, value, small in trees:
                    total += value.take(_place(root, codes, small))
                made[at : at + rows] = chance(total)
        return out


def _place(node: tuple | int, codes: list[np.ndarray], small: type) -> np.ndarray | int:
    """The leaf below ``node`` that each row meets."""
    if isinstance(node, int):
        return node
    feature, above, low, high = node
    right = (codes[feature] > above).view(np.uint8).astype(small, copy=False)
    if isinstance(low, int) and isinstance(high, int):
        return right | low
    low, high = _place(low, codes, small), _place(high, codes, small)
    return ((low ^ high) & np.negative(right)) ^ low


def coded(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """0 for a missing value, otherwise one more than the cuts below it."""
    return np.where(np.isnan(values), 0, 1 + np.searchsorted(cuts, values, "left"))


#: Rows whose counts and second slopes are summed in one number: both stay whole below 2 ** 53.
PACKED = (1 << 17) - 1
#: Cells of a joint histogram of several inputs, at most, and rows that are not worth one.
JOINT = 8192
FEW = 8192


class Histograms:
    """Sums over (node, input, bin) for coded rows.

    Inputs are counted together, as many as have few enough joint cells, and then summed apart; the
    sums are of whole numbers, so that each is exact. A few rows are counted in one go.
    """

    def __init__(self, bins: np.ndarray, width: int):
        self.inputs, self.width = len(bins), width
        self.flat = self.groups = None
        if bins.shape[1] <= FEW:
            self.flat = bins.T + np.arange(self.inputs) * width
            return
        sizes = bins.max(axis=1).astype(int) + 1
        self.groups, cells = [], JOINT + 1
        for j in np.argsort(sizes, kind="stable"):
            if cells * sizes[j] > JOINT:
                self.groups.append([])
                cells = 1
            self.groups[-1].append((int(j), int(sizes[j])))
            cells *= sizes[j]
        self.codes = []
        for group in self.groups:
            code = np.zeros(bins.shape[1], np.int64)
            for j, size in group:
                code = code * size + bins[j]
            self.codes.append(code.astype(np.min_scalar_type(math.prod(size for _, size in group))))

    def of(self, rows: np.ndarray | None, own: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Sums of ``g``, ``h`` and ones over the ``rows`` (all: None), of which each lies in the node ``own``."""
        out = np.zeros((3, nodes, self.inputs, self.width))
        packed = h * (PACKED + 1) + 1
        for at in range(0, len(own), PACKED):
            here = slice(at, at + PACKED)
            part = here if rows is None else rows[here]
            self._add(out, part, own[here], nodes, (g[part], packed[part]))
        return out

    def _add(self, out: np.ndarray, part: slice | np.ndarray, own: np.ndarray, nodes: int, weights: tuple[np.ndarray, ...]) -> None:
        def split(g: np.ndarray, both: np.ndarray) -> tuple[np.ndarray, ...]:
            h = np.floor(both / (PACKED + 1))
            return g, h, both - h * (PACKED + 1)

        if self.groups is None:
            cells = self.inputs * self.width
            key = (own[:, None] * cells + self.flat[part]).ravel()
            sums = (np.bincount(key, np.repeat(w, self.inputs), nodes * cells) for w in weights)
            out += np.stack(split(*sums)).reshape(out.shape)
            return
        for group, code in zip(self.groups, self.codes, strict=True):
            shape = nodes, *[size for _, size in group]
            cells = math.prod(shape[1:])
            key = own * cells + code[part]
            sums = [np.bincount(key, w, nodes * cells).reshape(shape) for w in weights]
            for i, (j, size) in enumerate(group):
                others = tuple(1 + o for o in range(len(group)) if o != i)
                out[:, :, j, :size] += np.stack(split(*[w.sum(axis=others) for w in sums]))

    def children(self, parents: np.ndarray, rows: np.ndarray, own: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The sums of both children of each of ``parents``: the one with fewer rows is counted, the other one is the rest."""
        sizes = np.bincount(own, minlength=2 * parents.shape[1]).reshape(-1, 2)
        fewer = (sizes[:, 1] < sizes[:, 0]).astype(np.int64)
        return self.both(parents, self.one_child(fewer, rows, own, g, h), fewer)

    def one_child(self, fewer: np.ndarray, rows: np.ndarray, own: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The sums of the child 0 or 1 of each parent that ``fewer`` names."""
        counted = fewer[own >> 1] == (own & 1)
        return self.of(rows[counted], own[counted] >> 1, len(fewer), g, h)

    def both(self, parents: np.ndarray, some: np.ndarray, fewer: np.ndarray) -> np.ndarray:
        nodes = len(fewer)
        out = np.empty((3, nodes, 2, self.inputs, self.width))
        out[:, np.arange(nodes), fewer] = some
        out[:, np.arange(nodes), 1 - fewer] = parents - some
        return out.reshape(3, 2 * nodes, self.inputs, self.width)


def bins_of(x: np.ndarray, cuts: list[np.ndarray], s: Setting) -> np.ndarray:
    """The code of each row, by input."""
    return np.stack([coded(x[:, j], c).astype(np.min_scalar_type(s.bins)) for j, c in enumerate(cuts)])


def grow(x: np.ndarray, y: np.ndarray, s: Setting) -> Trees:
    """Trees for inputs ``x`` (NaN: missing) and labels ``y`` (0 or 1); the first one is the base score."""
    cuts = [cut_points(c, s.bins) for c in x.T]
    bins = bins_of(x, cuts, s)
    return side_by_side([growing(bins, Histograms(bins, s.bins + 1), cuts, y, s)], lambda sums: sums)[0]


def side_by_side(models: list[Generator[np.ndarray, np.ndarray, Trees]], exchange: Exchange) -> list[Trees]:
    """Grow all models (see ``growing``) step by step; the sums of all their steps go through one exchange."""
    done: dict[int, Trees] = {}
    waiting = {i: next(m) for i, m in enumerate(models)}
    while waiting:
        totals = dict(zip(waiting, exchange(list(waiting.values())), strict=True))
        waiting = {}
        for i, total in totals.items():
            try:
                waiting[i] = models[i].send(total)
            except StopIteration as end:
                done[i] = end.value
    return [done[i] for i in range(len(models))]


def growing(bins: np.ndarray, histograms: Histograms, cuts: list[np.ndarray], y: np.ndarray, s: Setting) -> Generator[np.ndarray, np.ndarray, Trees]:
    """Grow trees over rows of which these are a part: yields sums over the part and is sent those over all rows.

    What is decided follows from the sums over all rows alone, so every part's trees are the same.
    """
    k, n = bins.shape
    width, penalty = s.bins + 1, s.l2 * SCALE
    size = 1 << (s.depth + 1)
    feature, cut = np.full((s.rounds + 1, size), -1), np.zeros((s.rounds + 1, size))
    value = np.zeros((s.rounds + 1, size), np.int64)
    positives, rows = yield np.array([y.sum(), n], float)
    value[0, 1] = first_score(int(positives), int(rows))
    score = np.full(n, value[0, 1])
    for t in range(1, s.rounds + 1):
        p = chance(score)
        g, h = whole((p - y) * SCALE), whole(p * (1 - p) * SCALE)
        node, active = np.ones(n, np.int64), np.arange(n)
        g_leaf, h_leaf = np.zeros(size), np.zeros(size)
        for level in range(s.depth):
            nodes, own = 1 << level, node[active] - (1 << level)
            if level:
                some = yield histograms.one_child(fewer, active, own, g, h)
                sums = histograms.both(sums * split[:, None, None], some, fewer)
            else:
                sums = yield histograms.of(None, own, nodes, g, h)
                g_leaf[1], h_leaf[1] = sums[:2, 0, 0].sum(axis=1)
            g_left, h_left, n_left = sums.cumsum(axis=3)
            g_all, h_all, n_all = (a[:, :, -1:] for a in (g_left, h_left, n_left))
            g_right, h_right = g_all - g_left, h_all - h_left
            gain = g_left * g_left / (h_left + penalty) + g_right * g_right / (h_right + penalty) - g_all * g_all / (h_all + penalty)
            gain[(n_left < s.least) | (n_all - n_left < s.least)] = -np.inf
            gain = gain.reshape(nodes, k * width)
            best = gain.argmax(axis=1)
            split = gain[np.arange(nodes), best] > 0
            f, b = np.divmod(best, width)
            at = np.arange(nodes), f, b
            sizes = n_left[at] * split, (n_all[at[0], f, 0] - n_left[at]) * split
            fewer = (sizes[1] < sizes[0]).astype(np.int64)
            for leaf, left, right in ((g_leaf, g_left[at], g_right[at]), (h_leaf, h_left[at], h_right[at])):
                leaf[2 * nodes : 4 * nodes] = np.stack([left * split, right * split], axis=1).ravel()
                leaf[nodes : 2 * nodes][split] = 0
            for i in np.flatnonzero(split):
                feature[t, nodes + i] = f[i]
                cut[t, nodes + i] = cuts[f[i]][b[i] - 1] if b[i] else np.nan
            active, own = active[split[own]], own[split[own]]
            node[active] = 2 * node[active] + (bins[f[own], active] > b[own])
            if not split.any():
                break
        value[t] = whole(-s.rate * SCALE * g_leaf / (h_leaf + penalty))
        score = score + value[t][node]
    return Trees(feature, cut, value)
