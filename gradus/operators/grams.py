"""Words of texts and numbers for their n-grams, a batch of rows at a time.

What tasks do with Arrow batches for ``vectors``: cutting cleaned texts into words, counting
words, counting n-grams of numbered words, and turning words into weighted entries. Every
function bounds what it holds by cutting batches into pieces; Spark deals out the rows and
sums the counts.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text, or words, that are handled at once.
PIECE_BYTES = 8 << 20
PIECE_WORDS = 1 << 20

_FOREIGN = re.compile("[^\x00-\x7f]+")
#: Bytes that may be in a word; every other byte is a blank.
_WORD_BYTES = bytes(b if chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for b in range(128)) + b" " * 128


class Folding(dict):
    """What characters become inside words, by code point; characters without an entry are blanks."""

    def __missing__(self, point: int) -> str:
        return " "


def pieces(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum to ``limit`` at most, or one row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, stop
        start = stop


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), "int32"), values)


def split_words(texts: pa.Array, folding: Folding, drop: Sequence[str]) -> pa.Array:
    """Words of two characters or more, not in ``drop``, of lower-case texts."""
    stop = pa.array(drop, "string")
    n_bytes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)

    def plain(text: str | None) -> str:
        if not text or text.isascii():
            return text or ""
        return _FOREIGN.sub(lambda found: found.group().translate(folding), text)

    def split(some: pa.Array) -> pa.Array:
        folded = pa.array([plain(t) for t in some.to_pylist()], "string")
        buffers = folded.buffers()
        offsets = np.frombuffer(buffers[1], "int32", len(folded) + 1)
        data = np.frombuffer((buffers[2].to_pybytes() if buffers[2] else b"").translate(_WORD_BYTES), "uint8")
        inside = data != 32
        # Words end at blanks and where a text ends.
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edges] |= inside[edges]
        ends[edges - 1] |= inside[edges - 1]
        first = np.flatnonzero(begins)
        length = np.flatnonzero(ends) + 1 - first
        inside[first[length == 1]] = False
        first, length = first[length > 1], length[length > 1]
        bounds = np.concatenate([[0], np.cumsum(length)]).astype("int32")
        flat = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(data[inside]))
        kept = pc.invert(pc.is_in(flat, value_set=stop))
        sizes = np.diff(np.searchsorted(first, offsets))
        row = np.repeat(np.arange(len(sizes)), sizes)[kept.to_numpy(zero_copy_only=False)]
        return _lists(flat.filter(kept), np.bincount(row, minlength=len(sizes)))

    found = [split(texts.slice(a, b - a)) for a, b in pieces(n_bytes, PIECE_BYTES)]
    return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.string()))


def _rows(words: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(rows, words of these rows, row of each word) for pieces of an array of lists."""
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    for a, b in pieces(sizes, PIECE_WORDS):
        yield b - a, words.slice(a, b - a).flatten(), np.repeat(np.arange(b - a), sizes[a:b])


def _documents(row: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """In how many rows each of the codes 0..n-1 is."""
    n = max(n, 1)
    pairs = np.sort(row * n + code)
    again = np.zeros(len(pairs), bool)
    again[1:] = pairs[1:] == pairs[:-1]
    return np.bincount(pairs[~again] % n, minlength=n)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, total, df) of the words of each piece, and '' with its rows; to be summed."""
    for batch in batches:
        for n, flat, row in _rows(batch.column(0)):
            known = pc.is_valid(flat).to_numpy(zero_copy_only=False)
            coded = flat.filter(pa.array(known)).dictionary_encode()
            code, terms = coded.indices.to_numpy().astype("int64"), coded.dictionary
            total = np.bincount(code, minlength=len(terms))
            held = _documents(row[known], code, len(terms))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([terms, pa.array([""], terms.type)]),
                    pa.array(np.append(total, n), "int64"),
                    pa.array(np.append(held, n), "int64"),
                ],
                names=["term", "total", "df"],
            )


def fits(n_words: int, ngram_max: int) -> bool:
    """Whether the numbers of n-grams of so many words fit a long."""
    return (n_words + 1) ** ngram_max < 2**63


def _gram_numbers(row: np.ndarray, code: np.ndarray, n: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of every n-gram whose words all have a code (-1: none).

    Numbers of n-grams of different n differ too: codes count from 1.
    """
    many = max(0, len(code) - n + 1)
    number, whole = np.zeros(many, "int64"), np.ones(many, bool)
    for j in range(n):
        part = code[j : j + many]
        number = number * (n_words + 1) + part + 1
        whole &= (part >= 0) & (row[j : j + many] == row[:many])
    return row[:many][whole], number[whole]


def _codes(flat: pa.Array, known: pa.Array) -> np.ndarray:
    found = pc.index_in(flat, value_set=known.cast(flat.type))
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype("int64")


def gram_name(number: int, words: Sequence[str]) -> str:
    """The n-gram of a number."""
    parts = []
    while number:
        number, code = divmod(number, len(words) + 1)
        parts.append(words[code - 1])
    return " ".join(reversed(parts))


def count_grams(
    batches: Iterator[pa.RecordBatch], known: pa.Array, ngram_max: int
) -> Iterator[pa.RecordBatch]:
    """(gram, total, df) of the 2..ngram_max-grams of ``known`` words in each piece; to be summed."""
    for batch in batches:
        for _, flat, row in _rows(batch.column(0)):
            code = _codes(flat, known)
            for n in range(2, ngram_max + 1):
                at, number = _gram_numbers(row, code, n, len(known))
                grams, place, total = np.unique(number, return_inverse=True, return_counts=True)
                held = _documents(at, place, len(grams))[: len(grams)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, "int64") for x in (grams, total, held)], names=["gram", "total", "df"]
                )


def entries(words: pa.Array, known: pa.Array, numbers: np.ndarray, places: np.ndarray, weights: np.ndarray, ngram_max: int) -> pa.Array:
    """Sparse vectors of length 1: how often each term occurs, times its weight.

    ``known``: the words of the terms; ``numbers``: the terms' numbers, ascending, and ``places``
    where each stands in the vocabulary.
    """
    size, parts = len(weights), []
    for n_rows, flat, row in _rows(words):
        code = _codes(flat, known)
        keys = []
        for n in range(1, ngram_max + 1):
            at, number = _gram_numbers(row, code, n, len(known))
            found = np.minimum(np.searchsorted(numbers, number), len(numbers) - 1)
            hit = numbers[found] == number if len(numbers) else np.zeros(len(number), bool)
            keys.append(at[hit] * size + places[found[hit]])
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        row, place = np.divmod(key, size)
        value = count * weights[place]
        norm = np.sqrt(np.bincount(row, value * value, n_rows))[row]
        value = np.divide(value, norm, out=value, where=norm != 0)
        sizes = np.bincount(row, minlength=n_rows)
        parts.append(
            pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(n_rows), "int8"),
                    pa.array(np.full(n_rows, size), "int32"),
                    _lists(pa.array(place, "int32"), sizes),
                    _lists(pa.array(value, "float64"), sizes),
                ],
                names=["type", "size", "indices", "values"],
            )
        )
    if parts:
        return pa.concat_arrays(parts)
    vector = [("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]
    return pa.array([], pa.struct(vector))
