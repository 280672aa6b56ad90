"""Ids of a word-based tokenizer of the tokenizers library for whole Arrow columns.

For tokenizers that drop white space and never join what it parts, a text has the ids of its words
one after another. So each different word of a batch is looked up once, lower-cased if it is ASCII
(the tokenizer ignores case) and with a closing ``.`` or ``,`` cut off behind a letter or digit
(where the tokenizer cuts too); only pieces not met before go to the library, many in one call,
parted by an added token. What was met is remembered up to a fixed number of pieces, which changes
no result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces remembered at most and pieces in one call of the library.
REMEMBERED = 1 << 20
TOGETHER = 1000


def ragged_take(starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Indices of the elements of the ragged rows ``which``, in order."""
    n = lengths[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts[which] - (ends - n), n)


def spans(lengths: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Sums of ``inner`` over rows that have ``lengths`` of its elements each."""
    total = np.concatenate(([0], np.cumsum(inner)))
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


class WordEncoder:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        added = self._library.get_added_tokens_decoder()
        self._between, self._special = next((i, t.content) for i, t in added.items() if t.special)
        self._openings = sorted({t.content[:2] for t in added.values()})
        self.size = self._library.get_vocab_size()
        self._most = remembered
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[str, int] = {}
        self._starts, self._lengths, self._ids, self._filled = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32), 0

    def _library_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths; pieces that may hold an added token are encoded alone."""
        plain = [i for i, p in enumerate(pieces) if not any(o in p for o in self._openings)]
        calls = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        alone = sorted(set(range(len(pieces))) - set(plain)) if len(plain) < len(pieces) else []
        texts = [self._special.join(pieces[i] for i in call) for call in calls] + [pieces[i] for i in alone]
        found: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(pieces)
        for k, encoded in enumerate(self._library.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoded.ids, np.uint32)
            if k < len(calls):
                cuts = np.flatnonzero(ids == self._between)
                for i, part in zip(calls[k], np.split(ids, cuts), strict=True):
                    found[i] = part
                for i in calls[k][1:]:
                    found[i] = found[i][1:]
            else:
                found[alone[k - len(calls)]] = ids
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return (np.concatenate(found) if found else np.zeros(0, np.uint32)), lengths

    def _lookup(self, pieces: list[str]) -> np.ndarray:
        if len(self._slots) + len(pieces) > self._most:
            self._forget()
        new = [p for p in pieces if p not in self._slots]
        if new:
            ids, lengths = self._library_ids(new)
            first = len(self._slots)
            self._slots.update(zip(new, range(first, first + len(new)), strict=True))
            self._starts = _put(self._starts, first, self._filled + np.cumsum(lengths) - lengths)
            self._lengths = _put(self._lengths, first, lengths)
            self._ids = _put(self._ids, self._filled, ids)
            self._filled += len(ids)
        return np.fromiter(map(self._slots.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the number of ids of each; null is empty."""
        words = pc.ascii_split_whitespace(column.fill_null(""))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary
        distinct = pc.if_else(pc.and_(pc.string_is_ascii(distinct), pc.invert(self._may_be_added(distinct))), pc.ascii_lower(distinct), distinct)
        distinct = pc.replace_substring_regex(distinct, r"([A-Za-z0-9])([.,])$", r"\1 \2")
        parts = pc.ascii_split_whitespace(distinct)
        pieces = parts.flatten().dictionary_encode()
        slots = self._lookup(pieces.dictionary.to_pylist())[pieces.indices.to_numpy(zero_copy_only=False)]
        word_lengths = spans(parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), self._lengths[slots])
        word_ids = self._ids[ragged_take(self._starts, self._lengths, slots)]
        which = coded.indices.to_numpy(zero_copy_only=False)
        ids = word_ids[ragged_take(np.cumsum(word_lengths) - word_lengths, word_lengths, which)]
        return ids, spans(words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), word_lengths[which])

    def _may_be_added(self, words: pa.Array) -> pa.Array:
        found = pc.match_substring(words, self._openings[0])
        for o in self._openings[1:]:
            found = pc.or_(found, pc.match_substring(words, o))
        return found


def _put(held: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """``held`` with ``new`` from ``at`` on, grown by halves."""
    if at + len(new) > len(held):
        grown = np.zeros(max(at + len(new), len(held) + len(held) // 2), held.dtype)
        grown[:at] = held[:at]
        held = grown
    held[at : at + len(new)] = new
    return held


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
