"""Main text of web pages by tag-path ratios.

Every block of text hangs at the end of a path of tags. For each path of a page the text
length, the punctuation and the share of text outside links are summed over its blocks; a
block's score fuses the three ratios of its path, is smoothed over its neighbours in page
order, and a threshold on the smoothed scores selects the content blocks. Paths through
elements that never hold an article (menus, forms, scripts, comments, adverts ...) score
nothing. The innermost container that holds most of the selected score is the article, with
all its other blocks. Where the way to it passes ``article`` or ``main`` elements, it is the
innermost of those.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from gradus.llm.arrow import extend, texts

#: A block votes for its containers from this share of the page's standard deviation on; a
#: container may be the article if it holds this share of the votes.
THRESHOLD, SHARE = 0.5, 0.7
#: Weights of a block's neighbours in page order, nearest first.
SMOOTHING = (1.0, 0.5, 0.25)

_RAW = "script|style|noscript|template|svg|math|iframe|textarea|select|title"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>",
    re.S | re.I,
)
_NAMED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？।؟]")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
_CONTAINERS = frozenset("body article main section div td center".split())
_DECLARED = frozenset(("article", "main"))
# What a head may hold; any other element ends an open one.
_METADATA = frozenset("base link meta noscript script style template title".split())
# Elements that never hold the article, and words that say so in a class, id or role.
_NEVER = frozenset("head nav header footer aside form button dialog menu option".split())
_NEVER_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie "
    "cookies consent disclaimer footer header login menu nav navbar navigation newsletter "
    "notice notices popup promo promotion related share sharing sidebar signup social sponsor "
    "sponsored subscribe widget banner complementary contentinfo search".split()
)
_WORD = re.compile(r"[a-z]+")
# Opening one of these ends an open one of the same family.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    containers: tuple[int, ...]
    declared: tuple[int, ...]  # those of the containers that are an article or main
    linked: int


def _vetoed(tag: str, rest: str) -> bool:
    if tag in _NEVER:
        return True
    if tag in ("html", "body", "article", "main") or not rest:
        return False
    return any(
        not _NEVER_WORDS.isdisjoint(_WORD.findall((a or b or c).lower())) for a, b, c in _NAMED.findall(rest)
    )


def blocks_of(page: str) -> list[Block]:
    """The page's blocks outside vetoed elements, white space squeezed, in page order."""
    open_tags: list[tuple[str, bool, int]] = []  # tag, vetoed (it or one above), container
    path: list[str] = []
    found: list[Block] = []
    parts: list[str] = []
    linked = 0
    serial = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                containers = tuple(number for _, _, number in open_tags if number)
                declared = tuple(n for tag, _, n in open_tags if tag in _DECLARED)
                found.append(Block(text, tuple(path), containers, declared, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(at: int) -> None:
        for tag, _, _ in open_tags[at:]:
            if tag not in _INLINE:
                path.pop()
        del open_tags[at:]

    last = 0
    for token in _TOKEN.finditer(page):
        start = token.start()
        if start > last and not (open_tags and open_tags[-1][1]):
            parts.append(page[last:start])
            if any(tag == "a" for tag, _, _ in open_tags):
                linked += start - last
        last = token.end()
        tag = token["tag"]
        if tag is None:
            if token["raw"] and parts:
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag not in _INLINE and tag != "br":
            flush()
        elif tag == "br" and parts:
            parts.append(" ")
        if token["end"]:
            for at in range(len(open_tags) - 1, -1, -1):
                if open_tags[at][0] == tag:
                    close(at)
                    break
                if tag in _INLINE and open_tags[at][0] not in _INLINE:
                    break
        elif tag not in _VOID:
            if tag == "body" or open_tags and open_tags[-1][0] == "head" and tag not in _METADATA:
                for at in range(len(open_tags) - 1, -1, -1):
                    if open_tags[at][0] == "head":
                        close(at)
                        break
            if tag not in _INLINE:
                ends = _SIBLINGS.get(tag, ())
                for at in range(len(open_tags) - 1, -1, -1):
                    name = open_tags[at][0]
                    if name == "p" or name in ends:
                        close(at)
                        break
                    if name not in _INLINE and name not in ("dd", "dt"):
                        break
                path.append(tag)
            serial += 1
            above = bool(open_tags) and open_tags[-1][1]
            number = serial if tag in _CONTAINERS else 0
            open_tags.append((tag, above or _vetoed(tag, token["rest"]), number))
    if last < len(page) and not (open_tags and open_tags[-1][1]):
        parts.append(page[last:])
    flush()
    return found


def _scores(blocks: list[Block]) -> list[float]:
    """Fused ratios of each block's path, smoothed in page order."""
    totals: dict[tuple[str, ...], list[int]] = {}
    for block in blocks:
        total = totals.setdefault(block.path, [0, 0, 0, 0])
        for i, value in enumerate((1, len(block.text), len(_PUNCTUATION.findall(block.text)), block.linked)):
            total[i] += value
    fused = {
        path: chars / n * (1 + marks / n) * (1 - linked / chars)
        for path, (n, chars, marks, linked) in totals.items()
    }
    raw = [fused[block.path] for block in blocks]
    smooth = []
    for i in range(len(raw)):
        weight = value = 0.0
        for distance, share in enumerate(SMOOTHING):
            for j in {i - distance, i + distance}:
                if 0 <= j < len(raw):
                    weight += share
                    value += share * raw[j]
        smooth.append(value / weight)
    return smooth


def main_text(page: str) -> str:
    """The article's blocks in page order, one a line; empty if there is none."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    scores = _scores(blocks)
    mean = sum(scores) / len(scores)
    deviation = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
    limit = min(THRESHOLD * deviation, max(scores))

    # Selected blocks vote for each container around them.
    weight: dict[int, float] = {}
    inside: dict[int, list[int]] = {}
    total = 0.0
    for block, score in zip(blocks, scores, strict=True):
        if score >= limit:
            total += score
            above = 0
            for number in block.containers:
                if number not in weight:
                    weight[number] = 0.0
                    inside.setdefault(above, []).append(number)
                weight[number] += score
                above = number
    # Inwards from the page, while the heaviest of siblings holds most of the score. The parts
    # of an article or main element on the way are the article's own, so it stays whole.
    declared = {number for block in blocks for number in block.declared}
    way = [0]
    while way[-1] in inside:
        heaviest = max(inside[way[-1]], key=weight.__getitem__)
        if weight[heaviest] < SHARE * total:
            break
        way.append(heaviest)
    root = max(declared.intersection(way), default=way[-1])
    return "\n".join(block.text for block in blocks if not root or root in block.containers)


def extract(df: DataFrame, html_column: str = "html") -> DataFrame:
    """``df`` plus ``text``, the main text of each page, and ``n_chars``, its code points.

    Character references are decoded, white space inside a block becomes one space, blocks
    are joined by one newline; nothing is capped. NULL and empty pages, and pages without an
    article, have the empty text; markup without tags is one block; damaged markup is read
    as far as it makes sense; repeated rows are read each. Columns of ``df`` by the two
    names are replaced; an empty table gives an empty one.
    """
    page = "_page"
    while page in df.columns:
        page += "_"
    df = df.withColumn(page, df[f"`{html_column}`"]).drop("text", "n_chars")

    def compute(batch: pa.RecordBatch) -> list[list]:
        found = [main_text(html) for html in texts(batch, page)]
        return [found, [len(text) for text in found]]

    return extend(df, "text string, n_chars long", compute).drop(page)
