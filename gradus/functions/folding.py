"""Accent folding: compatibility decomposition, then dropping combining marks.

Spark has no ``normalize`` function, but the folding works on each character by
itself, so it is a character table: one ``translate`` for the one-to-one and the
deleted characters, and a small map for characters that fold to several. The
tables come from Python's ``unicodedata`` once, on the driver.
"""

from __future__ import annotations

import json
import string
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = frozenset(string.ascii_lowercase + string.digits)

# Planes and blocks to look at: all but ideographs, Hangul syllables, surrogates and
# private use, which have no table entries (Hangul decomposes by arithmetic).
_BLOCKS = (
    range(0x80, 0x3400),
    range(0xA000, 0xAC00),
    range(0xF900, 0x17000),
    range(0x1AFF0, 0x20000),
    range(0x2F800, 0x2FA20),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def fold_string(text: str) -> str:
    """The same folding for driver-side constants (word lists, map keys)."""
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(c for c in decomposed if not unicodedata.combining(c))


@lru_cache(maxsize=2)
def _tables(words_only: bool) -> tuple[str, str, dict[str, str]]:
    """(from, to, multi) for ``translate``: ``from`` beyond ``to`` is deleted.

    ``words_only`` keeps just what can end in ``[a-z0-9]``: text cleaning turns every
    other character into a space anyway. Hangul syllables decompose into letters by
    arithmetic, not by table; no level or concept name has any, so they stay composed.
    """
    single: dict[str, str] = {}
    deleted: list[str] = []
    multi: dict[str, str] = {}
    for char in map(chr, chain(*_BLOCKS)):
        folded = fold_string(char)
        if folded == char:
            continue
        if not folded:
            deleted.append(char)
        elif words_only and not _WORD.intersection(folded):
            continue
        elif len(folded) == 1:
            single[char] = folded
        else:
            multi[char] = folded
    source = "".join(single) + "".join(deleted)
    return source, "".join(single.values()), multi


def word_folding() -> dict[int, str]:
    """What ``fold_for_words`` makes of single characters, by code point."""
    source, target, multi = _tables(words_only=True)
    single = {ord(c): target[i : i + 1] for i, c in enumerate(source)}
    return single | {ord(c): folded for c, folded in multi.items()}


def _char_class(chars: str) -> str:
    """A regex class of non-ASCII ``chars``, as ranges; ASCII is ruled out first."""
    points = sorted(map(ord, chars))
    ranges: list[list[int]] = []
    for point in points:
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    inside = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in ranges)
    return rf"(?:(?![\x00-\x7F])[{inside}])"


def _fold(value: Column, words_only: bool) -> Column:
    source, target, multi = _tables(words_only)
    special = _char_class("".join(multi))
    # One literal instead of thousands; Catalyst folds it to a constant map.
    table = F.from_json(F.lit(json.dumps(multi)), "map<string,string>")

    def expand(text: Column) -> Column:
        # Cut the text around the special characters only, so the map is consulted
        # for a handful of pieces, not for every character.
        pieces = F.split(text, f"(?<={special})|(?={special})")
        return F.array_join(
            F.transform(pieces, lambda p: F.coalesce(F.element_at(table, p), p)), ""
        )

    def fold(text: Column) -> Column:
        # Plain ASCII needs nothing; after the one-to-one table little else is left.
        singles = let(
            F.translate(text, source, target),
            lambda t: F.when(t.rlike(special), expand(t)).otherwise(t),
        )
        return F.when(text.rlike(r"[^\x00-\x7F]"), singles).otherwise(text)

    return let(value, fold)


def fold_accents(value: Column) -> Column:
    """Fold every character (for labels and names)."""
    return _fold(value, words_only=False)


def fold_for_words(value: Column) -> Column:
    """Fold just the characters that can reach ``[a-z0-9]`` (for text cleaning)."""
    return _fold(value, words_only=True)
