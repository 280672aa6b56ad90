"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decode.

Encoding. The encoding of a byte string is the one token sequence in which every neighbouring
pair (a, b) is stable: merging the bytes of a and b by rank gives a and b back. So the last token
of every prefix follows from the last tokens of the shorter prefixes, and a byte at a time is
enough. A transducer state is the last token emitted and the bytes read since; it holds the last
token of each of their prefixes. On a byte, the last token of the longer prefix is found, and all
tokens on which every prefix that a later token may still start from agrees are emitted: the
lookahead is bounded by the longest token. A transition and its state are made when asked for a
second time and kept; the first time, the rest of a piece of up to ``SHORT`` bytes is read with
all its open tokens side by side, so that what is met once leaves no states behind. Past
``max_states`` the table is emptied between two pieces of text and grows anew. Neither changes a
result.

Decoding. Tokens are turned into bytes in blocks; an incremental UTF-8 state machine holds back
the bytes of a character that is still open at the end of a block.

Null and empty texts have no tokens and decode to no bytes. Rows, repeats and other columns stay
as they are; ``ids`` and ``decoded`` replace columns of the same name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetspark.llm.shipping import map_batches

#: Pieces of text taken from the splitter at a time, and tokens decoded at a time.
BLOCK = 1 << 16
#: Longest rest of a piece, in bytes, that is read without making states.
SHORT = 64
_NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Tokens of byte strings under ``ranks``; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 150_000):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._length = {rank: len(token) for token, rank in ranks.items()}
        #: For each token and each beginning of one: (rank + 1, or 0) * 2 + (it may go on).
        self._parts = {token: (rank + 1) << 1 for token, rank in ranks.items()}
        for token in ranks:
            for k in range(1, len(token)):
                self._parts[token[:k]] = self._parts.get(token[:k], 0) | 1
        self._max_states = max_states
        self._stable: dict[int, bool] = {}
        self._edge_lists: dict[int, tuple[list, list]] = {}
        self._clear()

    def _clear(self) -> None:
        #: For each state: bytes read since the last emitted token, last token of each of their
        #: prefixes (the emitted one first), places and bytes of tokens that may still be open.
        self._states: list[tuple[bytes, tuple[int, ...], tuple[tuple[int, bytes], ...]]] = []
        self._names: dict[tuple[int, bytes], int] = {}
        self._next: dict[int, tuple[int, tuple[int, ...]]] = {}
        #: Transitions asked for once.
        self._met: set[int] = set()
        self._state(b"", (-1,), ((0, b""),))

    def _state(self, pending: bytes, ends: tuple[int, ...], live: tuple[tuple[int, bytes], ...]) -> int:
        name = self._names.setdefault((ends[0], pending), len(self._states))
        if name == len(self._states):
            self._states.append((pending, ends, live))
        return name

    def _edges(self, token: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]:
        """The first and the last parts a token has while its bytes are merged, lowest rank first
        and leftmost among equals, each with the rank of the merge that ends it; none for a token
        that merging does not make."""
        known = self._edge_lists.get(token)
        if known is None:
            text, rank = self.tokens[token], self.ranks.get
            parts = [text[i : i + 1] for i in range(len(text))]
            pairs = [rank(text[i : i + 2], _NEVER) for i in range(len(text) - 1)]
            left, right = [], []
            while pairs and (best := min(pairs)) < _NEVER:
                at = pairs.index(best)
                if at == 0:
                    left.append((parts[0], best))
                if at == len(pairs) - 1:
                    right.append((parts[-1], best))
                parts[at] += parts.pop(at + 1)
                del pairs[at]
                if at:
                    pairs[at - 1] = rank(parts[at - 1] + parts[at], _NEVER)
                if at < len(pairs):
                    pairs[at] = rank(parts[at] + parts[at + 1], _NEVER)
            whole = [(text, _NEVER)] if len(parts) == 1 else []
            known = self._edge_lists[token] = (left + whole, right + whole) if whole else ([], [])
        return known

    def _pair(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left`` (-1 at the start of a piece).

        It may not if a merge across their border comes before the merges that end the parts on
        both sides of it; parts that exist at the same time are walked through in that order.
        """
        key = left << 32 | right
        known = self._stable.get(key)
        if known is not None:
            return known
        if len(self._stable) >= 2 * self._max_states:
            self._stable.clear()
        firsts, known = self._edges(right)[0], False
        if left < 0:
            known = bool(firsts)
        elif firsts and (lasts := self._edges(left)[1]):
            i = j = 0
            while True:
                (x, x_ends), (y, y_ends) = lasts[i], firsts[j]
                across = self.ranks.get(x + y, _NEVER)
                if across < x_ends and across <= y_ends:
                    break
                if x_ends == y_ends == _NEVER:
                    known = True
                    break
                if x_ends <= y_ends:
                    i += 1
                else:
                    j += 1
        self._stable[key] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        pending, ends, live = self._states[state]
        letter, parts, length = bytes((byte,)), self._parts.get, self._length
        n, found, still = len(pending) + 1, -1, []
        for start, part in live:
            part += letter
            code = parts(part)
            if code is not None:
                if found < 0 and code > 1 and self._pair(ends[start], (code >> 1) - 1):
                    found = (code >> 1) - 1
                if code & 1:
                    still.append((start, part))
        if found < 0:
            raise ValueError("the ranks lack a single byte or a part of a token")
        ends += (found,)
        # Walk back until all open places meet: everything before that place is settled.
        cut, meet = n, [start for start, _ in still]
        while meet:
            if cut > meet[-1]:
                cut -= length[ends[cut]]
            elif cut < meet[-1]:
                at = meet.pop()
                at -= length[ends[at]]
                if at not in meet:
                    meet.append(at)
                    meet.sort()
            else:
                meet.pop()
        emitted, at = [], cut
        while at:
            emitted.append(ends[at])
            at -= length[ends[at]]
        still.append((n, b""))
        if cut:
            pending, ends = pending[cut:] + letter if cut < n else b"", ends[cut:]
            still = [(start - cut, part) for start, part in still]
        else:
            pending += letter
        arc = self._state(pending, ends, tuple(still)), tuple(reversed(emitted))
        self._next[state << 8 | byte] = arc
        return arc

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self._states) > self._max_states:
            self._clear()
        state, out, arcs, last = 0, [], self._next, len(piece) - 1
        for i, byte in enumerate(piece):
            arc = arcs.get(state << 8 | byte)
            if arc is None and (i == last or last - i < SHORT and self._first_time(state << 8 | byte)):
                return out + self._finish(state, piece, i)
            if arc is None:
                arc = self._step(state, byte)
                if len(self._states) > 2 * self._max_states:  # one piece made as many states as all others may
                    kept = self._states[arc[0]]
                    self._clear()
                    arcs, arc = self._next, (self._state(*kept), arc[1])
            state, emitted = arc
            if emitted:
                out += emitted
        _, ends, _ = self._states[state]
        return out + self._path(ends, len(ends) - 1)

    def _first_time(self, key: int) -> bool:
        """Whether a transition has not been asked for before; forgetting some only delays them."""
        if key in self._met:
            return False
        if len(self._met) >= 2 * self._max_states:
            self._met.clear()
        self._met.add(key)
        return True

    def _finish(self, state: int, piece: bytes, at: int) -> list[int]:
        """The tokens still open in ``state`` and those of the rest of ``piece`` from ``at`` on."""
        pending, ends, live = self._states[state]
        rest, ends = pending + piece[at:], list(ends)
        starts, parts, stable = [start for start, _ in live], self._parts.get, self._stable.get
        for end in range(len(pending) + 1, len(rest) + 1):
            found, still = -1, []
            for start in starts:
                code = parts(rest[start:end])
                if code is not None:
                    if found < 0 and code > 1:
                        token = (code >> 1) - 1
                        fits = stable(ends[start] << 32 | token)
                        if fits or fits is None and self._pair(ends[start], token):
                            found = token
                    if code & 1:
                        still.append(start)
            if found < 0:
                raise ValueError("the ranks lack a single byte or a part of a token")
            ends.append(found)
            still.append(end)
            starts = still
        return self._path(ends, len(rest))

    def _path(self, ends: Sequence[int], at: int) -> list[int]:
        rest = []
        while at:
            rest.append(ends[at])
            at -= self._length[ends[at]]
        return rest[::-1]


class PieceCache(dict):
    """Ids of short pieces as little-endian bytes, made when first asked for.

    Past ``most`` pieces a new generation begins; pieces of the one before it that are asked for
    again move over, the others are forgotten.
    """

    def __init__(self, encode, most: int = 250_000, longest: int = 64):
        super().__init__()
        self._encode, self._most, self._longest, self._before = encode, most, longest, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self._before.get(piece)
        if ids is None:
            tokens = self._encode(piece.encode())
            ids = pack(f"<{len(tokens)}I", *tokens)
        if len(piece) <= self._longest:
            if len(self) >= self._most:
                self._before = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Utf8Machine:
    """Bytes held back at the end of a block until their character is whole.

    States are the number of bytes that the open character still lacks.
    """

    #: Bytes that follow a lead byte.
    _FOLLOW = tuple(0 if b < 0xC2 else 1 if b < 0xE0 else 2 if b < 0xF0 else 3 if b < 0xF5 else 0 for b in range(256))

    def __init__(self) -> None:
        self._held = b""

    def feed(self, block: bytes) -> bytes:
        block = self._held + block
        lacking = back = 0
        for back in range(1, min(3, len(block)) + 1):
            byte = block[-back]
            if byte & 0xC0 != 0x80:
                lacking = max(0, self._FOLLOW[byte] - back + 1)
                break
        cut = len(block) - back if lacking else len(block)
        self._held = block[cut:]
        return block[:cut]

    def end(self) -> bytes:
        rest, self._held = self._held, b""
        return rest


class ByteBpe:
    """Encoder and decoder of one rank file; each task makes its own and keeps it."""

    def __init__(self, path: str, pattern: str, max_states: int = 150_000):
        self._split = regex.compile(pattern)
        self._transducer = Transducer(read_ranks(path), max_states)
        self._cache = PieceCache(self._transducer.encode)
        self._bytes = self._transducer.tokens

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        ids = self._cache.__getitem__
        if len(text) <= BLOCK:
            return b"".join(map(ids, self._split.findall(text)))
        pieces, parts = (m[0] for m in self._split.finditer(text)), []
        while part := b"".join(map(ids, islice(pieces, BLOCK))):
            parts.append(part)
        return b"".join(parts)

    def decode(self, ids: bytes | None) -> Iterator[bytes]:
        """Blocks of bytes, each of whole characters where the ids stand for text."""
        tokens, machine = np.frombuffer(ids or b"", "<u4"), Utf8Machine()
        for at in range(0, len(tokens), BLOCK):
            yield machine.feed(b"".join(map(self._bytes.__getitem__, tokens[at : at + BLOCK].tolist())))
        yield machine.end()


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary, 4 bytes a token) and ``decoded`` (binary, from the ids).

    ``path`` names a rank file that every executor can open. Texts never leave their task.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")]
    schema = T.StructType([*kept, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [codec.encode(t) for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                decoded = [b"".join(codec.decode(i)) for i in ids]
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], [f.name for f in schema]
                )

    return map_batches(docs, run, schema)
