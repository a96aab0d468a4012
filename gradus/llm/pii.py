"""Personal data: detection that sees through disguises and keeps source offsets.

Base identifiers are found in the text as it stands. Texts that may hold a disguise pass
through three transducers in turn: homoglyphs to ASCII, spelled-out digits to digits,
"at" and "dot" to their signs. Each step carries for every output character the span of
source characters it came from, so that what the same detectors find in the normalised
text is mapped back to the source.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from gradus.llm.arrow import extend, texts

KINDS = ("email", "ip", "card", "phone")

# The forms of identifiers. The first part of an email is taken backwards
# from its @, so that long runs of its characters cost no more than their length.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 == 0 else (digit * 2 - 9 if digit > 4 else digit * 2)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[Span]:
    for found in _IP.finditer(text):
        # By length first: a run of digits may be longer than int() takes.
        parts = [p.lstrip("0") for p in found[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield found.span()


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _cards(text: str) -> Iterator[Span]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = _digits(found[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[Span]:
    for found in _PHONE.finditer(text):
        if 8 <= len(_digits(found[0])) <= 15:
            yield found.span()


_FINDERS: dict[str, Callable[[str], Iterator[Span]]] = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones,
}
_ANY_DIGIT = re.compile("[0-9]")


def base_spans(text: str) -> dict[str, list[Span]]:
    """Per kind, the leftmost non-overlapping matches that pass their kind's test."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    if _ANY_DIGIT.search(text):
        for kind in KINDS[1:]:
            if kind != "phone" or "+" in text:
                found[kind] = list(_FINDERS[kind](text))
    return found


# Letters of other scripts that look like ASCII ones, in pairs.
_LOOKALIKES = dict(zip(
    "аеорсухіјѕԁАВЕКМНОРСТХ"
    "οανρΑΒΕΖΗΙΚΜΝΟΡΤΥΧ․‐‑‒–",
    "aeopcyxijsdABEKMHOPCTX"
    "oavpABEZHIKMNOPTYX.----",
    strict=True,
))
_NUMBERS = {
    name: str(i)
    for names in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for i, name in enumerate(names.split())
}


@lru_cache(maxsize=1)
def _homoglyphs() -> dict[str, str]:
    """The look-alikes, and whatever decomposes to one ASCII letter, digit or sign of an identifier."""
    table = dict(_LOOKALIKES)
    for low, high in ((0x2070, 0x209D), (0x2460, 0x2500), (0xFE50, 0xFE70), (0xFF01, 0xFF5F), (0x1D400, 0x1D800)):
        for char in map(chr, range(low, high)):
            plain = unicodedata.normalize("NFKC", char)
            if plain != char and len(plain) == 1 and (plain in _LOCAL or plain in "@()"):
                table[char] = plain
    return table


@lru_cache(maxsize=1)
def _patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern, re.Pattern]:
    glyphs = "[" + "".join(map(re.escape, _homoglyphs())) + "]"
    number = "(?:" + "|".join(sorted(_NUMBERS, key=len, reverse=True)) + ")"
    spelled = rf"(?i)(?<![^\W_]){number}(?:[ .,-]{{1,2}}(?:{number}|[0-9]+))+(?![^\W_])"
    # A sign in brackets counts anywhere; the bare words only as in "name at host dot tld".
    sign = r"(?i)[\[({<] {0,2}(?:at|@|dot|punkt|point|punto|arroba|\.) {0,2}[\])}>] {0,2}"
    bare = r"(?i)(?<![\w.%+-])[\w.%+-]{1,64} (?:at|arroba) [\w-]{1,63}(?: (?:dot|punkt|punto) [\w-]{1,63})+"
    return tuple(map(re.compile, (glyphs, spelled, sign, bare)))


class Traced:
    """A text whose characters know the source span they came from."""

    def __init__(self, text: str, starts: list[int], ends: list[int]):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, text: str) -> Traced:
        return cls(text, list(range(len(text))), list(range(1, len(text) + 1)))

    def rewrite(self, pieces: list[tuple[int, int, str]]) -> Traced:
        """Each (start, end, new) replaced; ``new`` as a whole stands for what it replaced."""
        text, starts, ends, last = [], [], [], 0
        for start, end, new in pieces:
            text += [self.text[last:start], new]
            starts += self.starts[last:start] + [self.starts[start]] * len(new)
            ends += self.ends[last:start] + [self.ends[end - 1]] * len(new)
            last = end
        text.append(self.text[last:])
        return Traced("".join(text), starts + self.starts[last:], ends + self.ends[last:])


def _counts(lowered: str) -> bool:
    """Whether two number words stand side by side; without, nothing is spelled out."""
    words = lowered.replace("-", " ").replace(",", " ").replace(".", " ").split()
    return b"\x01\x01" in bytes(map(_NUMBERS.__contains__, words))


def _sign(text: str) -> str:
    return "@" if re.search(r"(?i)at|@|arroba", text) else "."


def normalise(text: str) -> Traced | None:
    """The text without its disguises; None if it has none."""
    glyphs, spelled, sign, bare = _patterns()
    traced = None

    def step(pattern: re.Pattern, new: Callable[[re.Match], list[tuple[int, int, str]]]) -> None:
        nonlocal traced
        pieces = [p for m in pattern.finditer(traced.text if traced else text) for p in new(m)]
        if pieces:
            traced = (traced or Traced.of(text)).rewrite(pieces)

    def digits(m: re.Match) -> list[tuple[int, int, str]]:
        parts = re.findall(r"[^\W_]+", m[0])
        if len(parts) < 4:  # a phrase such as "one two", no number
            return []
        out, at = [], m.start()
        for i, found in enumerate(re.finditer(r"[^\W_]+", m[0])):
            if i:  # what separates two digits goes with the second
                out.append((at, m.start() + found.end(), _NUMBERS.get(found[0].lower(), found[0])))
            else:
                out.append((m.start(), m.start() + found.end(), _NUMBERS.get(found[0].lower(), found[0])))
            at = m.start() + found.end()
        return out

    def words(m: re.Match) -> list[tuple[int, int, str]]:
        return [
            (m.start() + x.start(), m.start() + x.end(), _sign(x[0]))
            for x in re.finditer(r"(?i) (?:at|arroba|dot|punkt|punto) ", m[0])
        ]

    def signs(m: re.Match) -> list[tuple[int, int, str]]:
        start = m.start()
        while m.start() - start < 2 and start and m.string[start - 1] == " ":
            start -= 1
        return [(start, m.end(), _sign(m[0]))]

    if not text.isascii() and not _homoglyphs().keys().isdisjoint(text):
        step(glyphs, lambda m: [(m.start(), m.end(), _homoglyphs()[m[0]])])
    plain = (traced.text if traced else text).lower()
    if _counts(plain):
        step(spelled, digits)
    if "[" in plain or "(" in plain or "{" in plain or "<" in plain:
        step(sign, signs)
    if " dot " in plain or " punkt " in plain or " punto " in plain:
        step(bare, words)
    return traced


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base, all): found as it stands; and with what only the normalised text shows.

    An added span overlaps no base span of its kind.
    """
    base = base_spans(text)
    traced = normalise(text)
    if traced is None:
        return base, base
    every = {}
    for kind, spans in base_spans(traced.text).items():
        mapped = [(traced.starts[a], traced.ends[b - 1]) for a, b in spans]
        # Both are in order and each apart in itself, so one neighbour decides.
        kept, begins, last = list(base[kind]), [a for a, _ in base[kind]], 0
        for a, b in mapped:
            before = bisect_left(begins, b) - 1
            if a >= last and (before < 0 or base[kind][before][1] <= a):
                kept.append((a, b))
                last = b
        every[kind] = sorted(kept)
    return base, every


def _listed(spans: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
    return [(kind, a, b) for kind in KINDS for a, b in spans[kind]]


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` plus ``base_spans`` and ``spans``: (kind, start, end) in code points, end exclusive.

    Both are ordered by kind (email, ip, card, phone), then start. ``spans`` has every base
    span and those that a disguise hid. NULL and empty texts have none; repeated rows are
    searched each; texts of any length are searched whole, in time proportional to their
    length. Columns of ``df`` by the two names are replaced; an empty table gives an empty one.
    """
    df = df.drop("base_spans", "spans")

    def compute(batch: pa.RecordBatch) -> list[list]:
        found = [all_spans(text) for text in texts(batch, text_column)]
        return [
            [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in _listed(f[i])] for f in found]
            for i in (0, 1)
        ]

    return extend(df, f"base_spans {_SPANS}, spans {_SPANS}", compute)


def redact(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with every span replaced by its kind, as in ``<email>``; other columns stay.

    Of overlapping spans of different kinds the one that starts first (then the longer) is
    replaced, extended to the end of the others. A NULL text stays NULL.
    """

    def compute(batch: pa.RecordBatch) -> list[list]:
        out = []
        for text in batch.column(text_column).to_pylist():
            if text:
                parts, last = [], 0
                spans = sorted(_listed(all_spans(text)[1]), key=lambda s: (s[1], -s[2]))
                for kind, start, end in spans:
                    if start >= last:
                        parts += [text[last:start], f"<{kind}>"]
                    last = max(last, end)
                text = "".join([*parts, text[last:]]) if spans else text
            out.append(text)
        return [out]

    name = "_redacted"
    while name in df.columns:
        name += "_"
    made = extend(df, f"{name} string", compute)
    return made.withColumn(text_column, made[name]).select(df.columns)
