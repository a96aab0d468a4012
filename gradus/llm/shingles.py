"""Sets of word shingles as sorted 64-bit numbers, many texts at a time."""

from __future__ import annotations

import numpy as np

_SEED = np.random.default_rng(20240229)
_LETTERS = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTERS[_SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD1342543DE82EF95)
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    found = _powers.get(int(base))
    if found is None or len(found) < n:
        room = max(n, 1 << 20)
        found = np.full(room, base, dtype=np.uint64)
        found[0] = 1
        np.multiply.accumulate(found, out=found)
        if n > 1 << 21:
            return found  # not kept: a single very long text
        _powers[int(base)] = found
    return found[:n]


def forget() -> None:
    """Gives back the tables of powers, which are quickly made again."""
    _powers.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_numbers(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all ``values``, and how many words each value has.

    A-Z are lower-cased; words are what ASCII white space separates.
    """
    buffer = np.frombuffer(b"\n".join(values).lower() + b"\n", dtype=np.uint8)
    inside = np.empty(len(buffer) + 1, dtype=bool)
    inside[0] = False
    np.logical_not(_SPACE[buffer], out=inside[1:])
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.cumsum(np.fromiter((len(v) + 1 for v in values), np.int64, len(values)))
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), counts
    # Spaces weigh nothing, so a sum up to the next word's start is the word's sum.
    weighed = _LETTERS[buffer] * _power(_BASE, len(buffer))
    sums = np.add.reduceat(weighed, starts) * _power(_BASE_INVERSE, len(buffer))[starts]
    return mix(sums), counts


def shingle_sets(values: list[bytes], width: int) -> list[np.ndarray]:
    """For each value its distinct shingles of ``width`` words, as sorted hashes.

    Fewer words make one shingle of them all, no words the empty set. Two different
    shingles get one number with probability 2**-64.
    """
    words, counts = word_numbers(values)
    ends = np.cumsum(counts)
    if len(words) >= width:
        rolled = words[: len(words) - width + 1].copy()
        for j in range(1, width):
            rolled *= _STEP
            rolled += words[j : len(words) - width + 1 + j]
        rolled = mix(rolled)
    sets = []
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        if count >= width:
            part = np.sort(rolled[end - count : end - width + 1])
            keep = np.empty(len(part), dtype=bool)
            keep[0] = True
            np.not_equal(part[1:], part[:-1], out=keep[1:])
            sets.append(part[keep])
        elif count:
            total = count
            for word in words[end - count : end].tolist():
                total = (total * int(_STEP) + word) % (1 << 64)
            sets.append(mix(np.array([total], dtype=np.uint64)))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
