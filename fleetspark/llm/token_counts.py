"""Token counts of byte-level BPE by rank-synchronous merging of ragged numpy arrays.

The pre-tokens of a batch of texts that were not met before lie end to end in one array of
symbols with the bounds of each. In every round each sequence finds its lowest merge rank, and
all places of that pair are merged in all sequences at once (from the left where they overlap).
A merge only makes pairs of higher rank than its own, so this gives the same symbols as one merge
after another. Sequences without a pair to merge leave the array; what is left of each is its
count. Counts of short pre-tokens are remembered up to a fixed number, which changes no result.

Strings of the vocabulary's added tokens inside a text count as one token each, as the tokenizer
takes them by default. Null and empty texts have no tokens. Rows, repeats and other columns stay;
``n_tokens`` replaces a column of that name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetspark.llm.shipping import map_batches

#: Pre-tokens counted at a time from one text, and symbols merged at a time.
BLOCK = 1 << 16
SYMBOLS = 1 << 20
_NONE = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class MergeTable:
    """Ranks and results of merges, looked up for whole arrays of pairs."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left, right, made = (
            np.array([vocabulary[t] for t in column], np.int64)
            for column in zip(*[(a, b, a + b) for a, b in pairs], strict=True)
        )
        self._size = np.int64(max(vocabulary.values()) + 1)
        keys = left * self._size + right
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks, self._made = keys[order], order.astype(np.int64), made
        self.bytes = np.array([vocabulary[c] for c in byte_letters()], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self._size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], _NONE)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each piece, none empty, after all merges."""
        counts = np.zeros(len(pieces), np.int64)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        which = np.arange(len(pieces))
        while len(which):
            bounds = np.cumsum(lengths)
            starts = bounds - lengths
            ranks = np.full(len(symbols), _NONE)
            ranks[:-1] = self.ranks(symbols[:-1], symbols[1:])
            ranks[bounds - 1] = _NONE  # no pair across two sequences
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == _NONE
            counts[which[done]] = lengths[done]
            hit = (ranks == np.repeat(lowest, lengths)) & (ranks < _NONE)
            # Of places in a row, which overlap, every second one is merged.
            places = np.flatnonzero(hit)
            if len(places):
                new_run = np.diff(places, prepend=-2) > 1
                run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(places)), 0))
                places = places[(np.arange(len(places)) - run_start) % 2 == 0]
                symbols[places] = self._made[ranks[places]]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            lengths = np.add.reduceat(keep, starts, dtype=np.int64)
            keep &= np.repeat(~done, bounds - starts)
            symbols, lengths, which = symbols[keep], lengths[~done], which[~done]
        return counts


class TokenCounter:
    """Counts under one tokenizer file; each task makes its own and keeps it."""

    def __init__(self, path: str, pattern: str, most: int = 600_000, longest: int = 64):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = not (model.get("ignore_merges") or model.get("dropout") or pre.get("add_prefix_space"))
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec["normalizer"] or not plain:
            raise ValueError(f"{path}: only plain byte-level BPE is counted")
        added = [t for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: added tokens that take their surroundings are not counted")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self._added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self._split = regex.compile(pattern)
        self._table = MergeTable(model["vocab"], model["merges"])
        self._known: dict[str, int] = {}
        self._most, self._longest = most, longest

    def _learn(self, pieces: list[str]) -> dict[str, int]:
        found, part, size = {}, [], 0
        for piece in [*pieces, None]:
            if part and (piece is None or size >= SYMBOLS):
                found.update(zip(part, self._table.count([p.encode() for p in part]).tolist(), strict=True))
                part, size = [], 0
            if piece is not None:
                part.append(piece)
                size += len(piece)
        return found

    def _total(self, lists: list[list[str]]) -> list[int]:
        """Tokens of each list of pre-tokens."""
        new = [p for p in set().union(*lists) if p not in self._known]
        if len(self._known) + len(new) > self._most:
            self._known.clear()
            new = list(set().union(*lists))
        found = self._learn(new)
        self._known.update(found)
        totals = [sum(map(self._known.__getitem__, pieces)) for pieces in lists]
        for piece in [p for p in new if len(p) > self._longest]:
            del self._known[piece]
        return totals

    def count(self, texts: list[str | None]) -> list[int]:
        totals, lists, owners, held = [0] * len(texts), [], [], 0

        def settle() -> None:
            for owner, n in zip(owners, self._total(lists), strict=True):
                totals[owner] += n

        for i, text in enumerate(texts):
            for k, part in enumerate(self._added.split(text or "") if self._added else [text or ""]):
                totals[i] += k > 0
                if len(part) <= BLOCK:
                    blocks = [self._split.findall(part)] if part else []
                else:
                    pieces = (m[0] for m in self._split.finditer(part))
                    blocks = iter(lambda: list(islice(pieces, BLOCK)), [])  # noqa: B023
                for block in blocks:
                    lists.append(block)
                    owners.append(i)
                    held += len(block)
                    if held > 4 * BLOCK:
                        settle()
                        lists, owners, held = [], [], 0
        settle()
        return totals


@lru_cache(maxsize=2)
def _counter(path: str, pattern: str) -> TokenCounter:
    return TokenCounter(path, pattern)


def with_token_counts(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` (long). ``path`` names a file that every executor can open."""
    kept = [f for f in docs.schema.fields if f.name != "n_tokens"]
    schema = T.StructType([*kept, T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                counts = counter.count(part.column(part.schema.get_field_index(text)).to_pylist())
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], [f.name for f in schema])

    return map_batches(docs, run, schema)
