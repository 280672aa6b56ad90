"""Arrow string columns as flat byte arrays, and their words as 64-bit hashes.

A word is a longest run of bytes outside space and 0x09-0x0D. All work is vectorised over the
rows of one Arrow batch and cut into windows of ``WINDOW`` bytes at white space, so that memory
does not follow the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at a time; a word longer than this is still taken whole.
WINDOW = 1 << 20
#: Bytes of text in a slice of a batch.
SLICE = 4 << 20

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_seeded = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _seeded.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_FOLDED = _BYTE.copy()
_BYTE_FOLDED[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and the n + 1 offsets of the rows in them; null rows are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return text[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 256), _BASE, np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, fold_case: bool = False, leads: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and the n + 1 offsets of the rows in that list.

    ``fold_case`` takes A-Z as a-z. No word crosses a row. With ``leads`` the hashes have a row for
    the whole words and one for each length in ``leads``, of the words' first so many bytes.
    """
    table = _BYTE_FOLDED if fold_case else _BYTE
    hashes, starts_all, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + WINDOW)
        while end < len(data) and _IS_WORD[data[end]]:
            white = np.flatnonzero(~_IS_WORD[data[end : end + WINDOW]])
            end = end + int(white[0]) if len(white) else min(len(data), end + WINDOW)
        part = data[at:end]
        inside = _IS_WORD[part]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > at) & (offsets < end)] - at
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        starts = np.flatnonzero(first)
        if len(starts):
            lengths = np.flatnonzero(last) + 1 - starts
            places = np.flatnonzero(inside)
            begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            within = np.arange(len(places)) - np.repeat(begins, lengths)
            values = table[part[places]] * _powers(int(lengths.max()))[within]
            found = [mix(np.add.reduceat(values, begins) + lengths.astype(np.uint64))]
            for lead in leads:
                sums = np.add.reduceat(np.where(within < lead, values, np.uint64(0)), begins)
                found.append(mix(sums + np.minimum(lengths, lead).astype(np.uint64)))
            hashes.append(found)
            starts_all.append(starts + at)
        at = end
    if not hashes:
        empty = np.zeros((1 + len(leads), 0), np.uint64)
        return (empty if leads else empty[0]), np.zeros(len(offsets), np.int64)
    joined = np.concatenate([np.stack(h) for h in hashes], axis=1)
    return (joined if leads else joined[0]), np.searchsorted(np.concatenate(starts_all), offsets, "left")


def slices(column: pa.Array, most: int = SLICE) -> list[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes of text, one row at least."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    cuts, at = [0], 0
    while at < len(sizes):
        limit = (ends[at - 1] if at else 0) + most
        at = max(at + 1, int(np.searchsorted(ends, limit, "right")))
        cuts.append(at)
    return list(zip(cuts, cuts[1:], strict=False))
