"""Periodic runs of words by grammar compression.

A run is a stretch of words with smallest period q and at least max(``LEAST``, ``TIMES`` * q) words that no
neighbouring word extends with that period. ``runs`` finds all runs of many texts at once:

* Texts without a window of ``SHARED`` words that stands in them twice have no run and need no grammar:
  a run of length n >= 24 and n >= 3q holds the same n - q >= 16 words at a distance of q.
* The word ids of the others are compressed by Re-Pair: the most frequent pairs of neighbours become
  nonterminals, in rounds that take all pairs with at least half the greatest count, of overlapping
  ones the more frequent one; when no pair stands twice, neighbours are paired whatever they are, until a text
  is one symbol. Each derivation position is met once, when its pair is replaced.
* The runs that cross the boundary between the two halves of a nonterminal are computed once, at its
  first position: for each period by the longest common extensions of the boundary and its
  shift, to both sides within the nonterminal. Extensions are exact; they compare ranks of
  substrings of power-of-two lengths.
* They are translated to all positions of the nonterminal, and of intervals with one period only the
  maximal ones are kept. Every run crosses the boundary of the smallest nonterminal around it, so
  none is lost; of equal intervals the smallest period is the run's.

All steps are numpy over the texts of one slice of an Arrow batch, of ``BYTES`` bytes at most unless one text is longer;
memory follows that slice. Null and empty texts have no words and no runs. Texts of any length are taken whole, rows that repeat are alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetspark.llm.arrow_text import mix, slices
from fleetspark.llm.shipping import map_batches

#: A run has this many words and periods at least, so it repeats a window of this many words.
LEAST, TIMES = 24, 3
SHARED = LEAST - LEAST // TIMES
#: Pairs of (nonterminal, period) looked at at a time, and bytes of text worked on at a time.
PAIRS = 1 << 20
BYTES = 4 << 20


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of all texts, the word numbers of the texts end to end, and their n + 1 bounds."""
    split = pc.ascii_split_whitespace(column.fill_null("").cast(pa.large_string()))
    coded = split.flatten().dictionary_encode()
    lengths = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # Splitting leaves an empty word before leading and behind closing white space, and in empty texts.
    empty = pc.index(coded.dictionary, "").as_py()
    words = ids != empty
    bounds = np.concatenate(([0], np.cumsum(words)))[np.concatenate(([0], np.cumsum(lengths)))]
    return coded.dictionary, ids[words], bounds


def _owners(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def may_have_runs(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text, whether any window of ``SHARED`` words stands in it twice (by hash: never a false no)."""
    out = np.zeros(len(bounds) - 1, bool)
    n = len(ids) - SHARED + 1
    if n <= 0:
        return out
    h = mix(ids.astype(np.uint64) + np.uint64(1))
    width = 1
    while width < SHARED:  # 16 words by doubling
        h = mix(h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:])
        width *= 2
    owner = _owners(bounds)[:n]
    inside = np.arange(n) + SHARED <= bounds[owner + 1]
    h, owner = h[inside] ^ mix(owner[inside].astype(np.uint64)), owner[inside]
    order = np.argsort(h)
    again = h[order][1:] == h[order][:-1]
    out[owner[order][1:][again]] = True
    return out


class Extensions:
    """Exact common extensions in a text of word numbers, by ranks of substrings of power-of-two lengths."""

    def __init__(self, ids: np.ndarray, longest: int):
        _, rank = np.unique(ids, return_inverse=True)
        self._ranks, width = [rank.astype(np.int32)], 1
        while 2 * width <= longest:
            rank = self._ranks[-1]
            pairs = rank[:-width].astype(np.int64) * (int(rank.max(initial=0)) + 1) + rank[width:]
            _, rank = np.unique(pairs, return_inverse=True)
            self._ranks.append(rank.astype(np.int32))
            width *= 2

    def forward(self, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and ``b`` on are the same, a < b, before ``end``."""
        found = np.zeros(len(a), np.int64)
        for k in range(len(self._ranks) - 1, -1, -1):
            width, rank = 1 << k, self._ranks[k]
            for _ in range(2 if k == len(self._ranks) - 1 else 1):
                fits = np.flatnonzero(b + found + width <= end)
                same = rank[a[fits] + found[fits]] == rank[b[fits] + found[fits]]
                found[fits[same]] += width
        return found

    def backward(self, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
        """How many words up to ``a`` and ``b``, both included, are the same, a < b, from ``start`` on."""
        found = np.zeros(len(a), np.int64)
        for k in range(len(self._ranks) - 1, -1, -1):
            width, rank = 1 << k, self._ranks[k]
            for _ in range(2 if k == len(self._ranks) - 1 else 1):
                fits = np.flatnonzero(a - found - width + 1 >= start)
                x, y = a[fits] - found[fits] - width + 1, b[fits] - found[fits] - width + 1
                found[fits[rank[x] == rank[y]]] += width
        return found


@dataclass
class Grammar:
    """Nonterminals of at least ``LEAST`` words, and all their derivation positions.

    ``first``, ``left`` and ``size`` give a nonterminal's first position, the words of its left half and all its
    words; position ``at[i]`` derives nonterminal ``which[i]``.
    """

    first: np.ndarray
    left: np.ndarray
    size: np.ndarray
    which: np.ndarray
    at: np.ndarray


def re_pair(ids: np.ndarray, bounds: np.ndarray) -> Grammar:
    """One grammar for the texts end to end in ``ids``; no pair crosses the bounds of a text."""
    symbol, start = ids.copy(), np.arange(len(ids))
    owner, next_symbol = _owners(bounds), int(ids.max(initial=0)) + 1
    parts: list[tuple[np.ndarray, ...]] = []
    made = 0
    frequent = True
    while True:
        joined = owner[:-1] == owner[1:]
        if not joined.any():
            break
        size = np.diff(np.append(start, len(ids)))
        pair = np.flatnonzero(joined)
        key = symbol[pair] * next_symbol + symbol[pair + 1]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        if frequent and count.max() < 2:
            frequent = False
        # The weight of each place: how often its pair stands there, then the pair itself.
        weight = np.zeros(len(symbol), np.int64)
        if frequent:
            taken = count[which] >= max(2, int(count.max()) // 2)
            weight[pair[taken]] = count[which[taken]] * len(count) + which[taken] + 1
            before = np.concatenate(([0], weight[:-1]))
            after = np.append(weight[1:], 0)
            place = np.flatnonzero((weight > 0) & (weight >= before) & (weight >= after))
            # In a row of the same pair, as in a a a a, every second place.
            new = np.diff(place, prepend=-2) > 1
            since = np.arange(len(place)) - np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))
            place = place[since % 2 == 0]
        else:
            place = pair[(pair - np.searchsorted(owner, owner[pair])) % 2 == 0]
        names, first, which = np.unique(symbol[place] * next_symbol + symbol[place + 1], return_index=True, return_inverse=True)
        total = size[place] + size[place + 1]
        long = total >= LEAST
        number = np.full(len(names), -1)
        keep = np.flatnonzero(long[first])  # all places of a nonterminal have its size
        number[keep] = made + np.arange(len(keep))
        made += len(keep)
        parts.append((start[place[first[keep]]], size[place[first[keep]]], total[first[keep]], number[which[long]], start[place[long]]))
        symbol[place] = next_symbol + which
        next_symbol += len(names)
        rest = np.ones(len(symbol), bool)
        rest[place + 1] = False
        symbol, start, owner = symbol[rest], start[rest], owner[rest]
        if next_symbol > 1 << 30:  # pairs are keyed by products of symbols
            _, symbol = np.unique(symbol, return_inverse=True)
            next_symbol = int(symbol.max()) + 1
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 5
    return Grammar(*columns)


def _crossing(g: Grammar, ids: np.ndarray, same: Extensions) -> tuple[np.ndarray, ...]:
    """Runs over the boundary of each nonterminal: (nonterminal, start within it, length, period)."""
    found = []
    most = g.size // TIMES
    done = 0
    ends = np.cumsum(most)
    while done < len(most):
        last = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, "right")))
        node = np.repeat(np.arange(done, last), most[done:last])
        q = np.arange(len(node)) - np.repeat(np.cumsum(most[done:last]) - most[done:last], most[done:last]) + 1
        lo, hi, b = g.first[node], g.first[node] + g.size[node], g.first[node] + g.left[node]
        # A run reaches a whole period beyond the boundary or before it; then the words at it repeat.
        for shift in (0, 1):
            a = b - shift * q
            at = np.flatnonzero((a >= lo) & (a + q < hi) if shift else (a + q <= hi))
            at = at[ids[a[at] - 1 + shift] == ids[a[at] - 1 + shift + q[at]]]
            x, p = a[at], q[at]
            back = same.backward(x - 1, x - 1 + p, lo[at])
            on = same.forward(x, x + p, hi[at])
            length = p + back + on
            run = length >= np.maximum(LEAST, TIMES * p)
            found.append((node[at][run], (x - back - lo[at])[run], length[run], p[run]))
        done = last
    node, start, length, period = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
    order = np.lexsort((period, length, start, node))
    node, start, length, period = node[order], start[order], length[order], period[order]
    smallest = np.ones(len(node), bool)
    smallest[1:] = (np.diff(node) != 0) | (np.diff(start) != 0) | (np.diff(length) != 0)
    return node[smallest], start[smallest], length[smallest], period[smallest]


def runs(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period; starts count from the text's first word."""
    chosen = np.flatnonzero(may_have_runs(ids, bounds))
    sizes = np.diff(bounds)[chosen]
    if not len(chosen):
        return (np.zeros(0, np.int64),) * 4
    inner = np.concatenate(([0], np.cumsum(sizes)))
    part = ids[np.arange(inner[-1]) + np.repeat(bounds[chosen] - inner[:-1], sizes)]
    g = re_pair(part, inner)
    same = Extensions(part, int(sizes.max()))
    node, start, length, period = _crossing(g, part, same)
    # Each run of a nonterminal at each of its positions.
    order = np.argsort(g.which, kind="stable")
    places = g.at[order]
    firsts = np.searchsorted(g.which[order], node)
    times = np.searchsorted(g.which[order], node, "right") - firsts
    which = np.repeat(np.arange(len(node)), times)
    at = places[np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + firsts[which]]
    start, length, period = at + start[which], length[which], period[which]
    text = np.searchsorted(inner, start, "right") - 1
    # Maximal intervals: sorted by start, longest first, one is inside another if it ends by the furthest end so far.
    order = np.lexsort((-length, start, period, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    end = start + length
    group = np.cumsum(np.concatenate(([0], (np.diff(text) != 0) | (np.diff(period) != 0)))[: len(text)])
    lift = group * (len(part) + 1)  # ends of later groups are beyond those of earlier ones
    furthest = np.maximum.accumulate(end + lift) - lift
    maximal = np.ones(len(text), bool)
    maximal[1:] = (end[1:] > furthest[:-1]) | (np.diff(group) != 0)
    text, start, length, period = text[maximal], start[maximal], length[maximal], period[maximal]
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    smallest = np.ones(len(text), bool)
    smallest[1:] = (np.diff(text) != 0) | (np.diff(start) != 0) | (np.diff(length) != 0)
    text, start, length, period = text[smallest], start[smallest], length[smallest], period[smallest]
    order = np.lexsort((period, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    return chosen[text], start - inner[text], length, period


def in_repeats(bounds: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """For each word, whether a run holds it behind that run's first period."""
    change = np.zeros(int(bounds[-1]) + 1, np.int64)
    np.add.at(change, bounds[text] + start + period, 1)
    np.add.at(change, bounds[text] + start + length, -1)
    return np.cumsum(change)[:-1] > 0


def joined(dictionary: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The texts of word numbers, words parted by one space."""
    words = dictionary.take(pa.array(ids))
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words), pa.scalar(" ", pa.large_string()))


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (array of start, length, period, by start and period) and ``collapsed``.

    ``collapsed`` is the text of the words that no run holds behind its first period, parted by single
    spaces. Rows and other columns stay; columns of these two names are replaced.
    """
    run_type = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    kept = [f for f in docs.schema.fields if f.name not in ("runs", "collapsed")]
    schema = T.StructType([*kept, T.StructField("runs", T.ArrayType(run_type)), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text)
            for first, last in slices(batch.column(place), BYTES):
                part = batch.slice(first, last - first)
                dictionary, ids, bounds = words_of(part.column(place))
                which, *columns = runs(ids, bounds)
                dropped = in_repeats(bounds, which, *columns)
                left = np.concatenate(([0], np.cumsum(~dropped)))[bounds]
                per_text = np.searchsorted(which, np.arange(part.num_rows + 1))
                found = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"])
                found = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), found)
                texts = joined(dictionary, ids[~dropped], left).cast(pa.string())
                others = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*others, found, texts], [f.name for f in schema])

    return map_batches(docs, run, schema)
