"""Byte-level BPE by a lazily determinised finite-state transducer.

A sequence of tokens is the BPE encoding of its bytes exactly if each pair of neighbours is
the encoding of that pair's bytes. So encoding is a path through a nondeterministic
transducer: read the bytes of a token along the trie of the vocabulary, emit it, and go on
with another token that may follow it. The transducer is made deterministic while it runs:
a state is the set of paths still open, each with its place in the trie and the token
before it, and a transition says which path each new one goes on from and what it emits.
As soon as one path is left, its tokens leave, so the lookahead is bounded by the bytes
over which paths differ. Exactly one path ends with the piece. States and transitions are
made when they are first met, and kept up to a bound.

Decoding is a stream: token bytes go through an incremental UTF-8 state machine that gives
out characters as they become whole and keeps at most three bytes.
"""

from __future__ import annotations

import base64
import codecs
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gradus.llm.arrow import extend, texts

#: Transitions remembered by one worker; beyond, they are made anew.
TRANSITIONS = 300_000
#: Pairs and pieces remembered, in each of two generations: what is used again moves to the
#: younger one, the rest goes when that is full.
PAIRS, PIECES = 80_000, 250_000
#: Tokens that a decoding step takes.
STEP = 4096

# Numbers stand for pairs, to keep many states small. A path: trie node and the token before
# it (0: none), as node << 24 | token + 1. A step: the next state, then for each of its paths
# the path it goes on from and the token it ends (0: none), as token + 1 << 8 | path.
_BITS, _LOW = 24, (1 << 24) - 1
# While a step is made, a path and its code are one number: path << 32 | code.
_CODE, _LAST = 32, (1 << 32) - 1
_NEVER = 1 << 62


class Transducer:
    """Encodes pieces of bytes with the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], share: float = 1.0):
        self.ranks = ranks
        self.most_pairs, self.most_moves = int(PAIRS * share), int(TRANSITIONS * share)
        self.token = {rank: value for value, rank in ranks.items()}
        self.pairs: dict[int, bool] = {}
        self.older_pairs: dict[int, bool] = {}
        # The trie of the tokens: node << 8 | byte to the next node; whether it goes on; its token.
        self.edges: dict[int, int] = {}
        self.inner = bytearray(1)
        self.accepts: list[int] = [-1]
        # Of a token, the parts that stand at its start and at its end while it is merged.
        self.heads: dict[int, tuple[int, ...]] = {}
        self.tails: dict[int, tuple[int, ...]] = {}
        for value, rank in sorted(ranks.items(), key=lambda x: (len(x[0]), x[1])):
            left, right = self._last_merge(value)
            if len(value) == 1:
                self.heads[rank] = self.tails[rank] = (rank,)
            elif left in self.heads and right in self.tails:  # else no merge makes it
                self.heads[rank] = (*self.heads[left], rank)
                self.tails[rank] = (*self.tails[right], rank)
            else:
                continue
            self._insert(value, rank)
        self.reset()

    def _insert(self, value: bytes, rank: int) -> None:
        node = 0
        for byte in value:
            after = self.edges.get(node << 8 | byte)
            if after is None:
                after = self.edges[node << 8 | byte] = len(self.accepts)
                self.inner[node] = 1
                self.inner.append(0)
                self.accepts.append(-1)
            node = after
        self.accepts[node] = rank

    def reset(self) -> None:
        self.states: list[tuple[int, ...]] = [(0,)]
        self.numbers: dict[tuple[int, ...], int] = {(0,): 0}
        self.moves: dict[int, tuple[int, ...]] = {}

    def forget(self) -> None:
        self.pairs.clear()
        self.older_pairs.clear()
        self.reset()

    def _last_merge(self, value: bytes) -> tuple[int, int]:
        """The two tokens left before ``value`` is whole; (-1, -1) if it never is."""
        parts = [value[i : i + 1] for i in range(len(value))]
        while len(parts) > 2:
            found = [
                (rank, i)
                for i in range(len(parts) - 1)
                if (rank := self.ranks.get(parts[i] + parts[i + 1])) is not None
            ]
            if not found:
                return -1, -1
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) < 2:
            return -1, -1
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _follows(self, before: int, after: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes.

        While both are merged, the last part of the first and the first part of the second
        meet; merges come in the order of ranks, so the two stay apart unless what meets
        makes a token that comes before the next merge on either side (left of an equal one).
        """
        pair = before << _BITS | after
        known = self.older_pairs.get(pair)
        if known is None:
            known = self._apart(before, after)
        if len(self.pairs) >= self.most_pairs:
            self.older_pairs, self.pairs = self.pairs, {}
        self.pairs[pair] = known
        return known

    def _apart(self, before: int, after: int) -> bool:
        tails, heads = self.tails[before], self.heads[after]
        rank, token = self.ranks.get, self.token
        i = j = 0
        while True:
            left = tails[i + 1] if i + 1 < len(tails) else _NEVER
            right = heads[j + 1] if j + 1 < len(heads) else _NEVER
            across = rank(token[tails[i]] + token[heads[j]], _NEVER)
            if across < left and across <= right and across < _NEVER:
                return False
            if left == right == _NEVER:
                return True
            if left <= right:
                i += 1
            else:
                j += 1

    def _move(self, state: int, byte: int) -> tuple[int, ...]:
        """One step, made when it is first needed."""
        made: list[int] = []
        edge, pair = self.edges.get, self.pairs.get
        for origin, path in enumerate(self.states[state]):
            after = edge(path >> _BITS << 8 | byte)
            if after is None:
                continue
            before = path & _LOW
            if self.inner[after]:
                made.append((after << _BITS | before) << _CODE | origin)
            token = self.accepts[after]
            if token >= 0:
                apart = not before or pair(before - 1 << _BITS | token)
                if apart is None:
                    apart = self._follows(before - 1, token)
                if apart:
                    made.append(token + 1 << _CODE | token + 1 << 8 | origin)
        if not made:
            raise ValueError("the vocabulary lacks a byte")
        # The path that is at the root, if there is one, comes first.
        if len(made) > 1:
            made.sort()
        paths = tuple([m >> _CODE for m in made])
        number = self.numbers.get(paths)
        if number is None:
            number = self.numbers[paths] = len(self.states)
            self.states.append(paths)
        step = self.moves[state << 8 | byte] = (number, *[m & _LAST for m in made])
        return step

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.moves) > self.most_moves:
            self.reset()
        out: list[int] = []
        steps: list[tuple[int, ...]] = []  # those whose tokens are not yet out
        state, known = 0, self.moves.get
        for byte in piece:
            step = known(state << 8 | byte) or self._move(state, byte)
            state = step[0]
            if len(step) > 2:
                steps.append(step)
            elif steps:  # one path is left: all before it is certain
                steps.append(step)
                out += _told(steps, 0)
                steps.clear()
            elif step[1] > 255:
                out.append((step[1] >> 8) - 1)
        if self.states[state][0] > _LOW:
            raise ValueError("the vocabulary lacks a byte")
        return out + _told(steps, 0) if steps else out


def _told(steps: list[tuple[int, ...]], path: int) -> list[int]:
    """The tokens on the way to ``path`` of the last step."""
    tokens = []
    for step in reversed(steps):
        code = step[path + 1]
        if code > 255:
            tokens.append((code >> 8) - 1)
        path = code & 255
    tokens.reverse()
    return tokens


class _Pieces(dict):
    """Piece to its token ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, transducer: Transducer, most: int):
        super().__init__()
        self.transducer, self.encode, self.most = transducer, transducer.encode, most
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        value = self.older.get(piece)
        if value is None:
            value = array("I", self.encode(piece.encode())).tobytes()
            if len(piece) > 64:
                return value
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[piece] = value
        return value


#: White space as the pattern means it.
_SPACE = r"\t-\r \x85\xa0  -     　"


class Codec:
    """A vocabulary file of ranks with the pattern that splits texts before the merges."""

    def __init__(self, path: str, pattern: str, share: float = 1.0):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        transducer = Transducer(ranks, share)
        self.token = transducer.token
        self.pieces = _Pieces(transducer, int(PIECES * share))
        # \s would also take the separators U+001C to U+001F.
        spaced = pattern.replace(r"[^\s", rf"[^{_SPACE}").replace(r"\S", rf"[^{_SPACE}]")
        self.split = regex.compile(spaced.replace(r"\s", f"[{_SPACE}]"), regex.V0).findall

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The text in parts; bytes that are no UTF-8 come out as U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        numbers = iter(ids)
        while step := b"".join(map(self.token.__getitem__, islice(numbers, STEP))):
            yield machine.decode(step)
        yield machine.decode(b"", final=True)


    def forget(self) -> None:
        """Gives back all but the vocabulary. Texts make new pieces without end, so the next
        task gains little from this one's."""
        self.pieces.clear()
        self.pieces.older.clear()
        self.pieces.transducer.forget()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, share: float = 1.0) -> Codec:
    """One for each worker process. ``share`` is of what it may remember."""
    return Codec(path, pattern, share)


def encode(df: DataFrame, path: str, pattern: str, text_column: str = "text") -> DataFrame:
    """``df`` plus ``ids`` (array of ints): each text's tokens, without special tokens.

    ``path`` is a rank file that every executor can read, ``pattern`` splits a text into
    pieces. NULL and empty texts have no tokens; texts of any length are encoded whole;
    repeated rows are encoded each. A column ``ids`` of ``df`` is replaced; an empty table
    gives an empty one.
    """
    df = df.drop("ids")

    def compute(batch: pa.RecordBatch) -> list:
        own = codec(path, pattern)
        return [_arrays([own.encode(text) for text in texts(batch, text_column)])]

    return extend(df, "ids array<int>", compute, lambda: codec(path, pattern).forget())


def _arrays(rows: list[bytes]) -> pa.Array:
    """Packed ids as an array column, without a Python number for each."""
    ends = np.cumsum([0, *(len(ids) // 4 for ids in rows)], dtype=np.int32)
    values = np.frombuffer(b"".join(rows), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def round_trip(df: DataFrame, path: str, pattern: str, text_column: str = "text", share: float = 0.4) -> DataFrame:
    """``df`` plus ``ids``, ``n_tokens`` and ``round_trip``: encoded and decoded in one pass.

    ``round_trip`` tells whether the ids decode to the text. Cases as in ``encode``.
    It runs after other stages in the same workers, so it remembers only ``share`` of what the
    others do: less memory, somewhat more time.
    """
    df = df.drop("ids", "n_tokens", "round_trip")

    def compute(batch: pa.RecordBatch) -> list:
        own = codec(path, pattern, share)
        values = texts(batch, text_column)
        made = [own.encode(text) for text in values]
        same = ["".join(own.decode(array("I", ids))) == t for ids, t in zip(made, values, strict=True)]
        return [_arrays(made), [len(ids) // 4 for ids in made], same]

    return extend(df, "ids array<int>, n_tokens long, round_trip boolean", compute, lambda: codec(path, pattern, share).forget())


def decode(df: DataFrame, path: str, pattern: str, ids_column: str = "ids") -> DataFrame:
    """``df`` plus ``decoded``: the text of the token ids, NULL ids as empty."""
    df = df.drop("decoded")

    def compute(batch: pa.RecordBatch) -> list[list]:
        own = codec(path, pattern)
        rows = batch.column(ids_column)
        return [["".join(own.decode(ids.as_py() or ())) for ids in rows]]

    return extend(df, "decoded string", compute, lambda: codec(path, pattern).forget())


def digests(df: DataFrame, path: str, pattern: str, text_column: str = "text") -> DataFrame:
    """``df`` plus ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    Encodes and decodes in one pass and keeps the digests only: of the ids as little-endian
    unsigned 32-bit numbers and of the decoded bytes, in lower-case hex. Cases as in
    ``encode``; columns by the three names are replaced.
    """
    df = df.drop("n_tokens", "ids_sha256", "decoded_sha256")

    def compute(batch: pa.RecordBatch) -> list[list]:
        own = codec(path, pattern)
        out: list[list] = [[], [], []]
        for text in texts(batch, text_column):
            ids = own.encode(text)
            decoded = sha256()
            for part in own.decode(array("I", ids)):
                decoded.update(part.encode())
            out[0].append(len(ids) // 4)
            out[1].append(sha256(ids).hexdigest())
            out[2].append(decoded.hexdigest())
        return out

    return extend(df, "n_tokens long, ids_sha256 string, decoded_sha256 string", compute, lambda: codec(path, pattern).forget())
