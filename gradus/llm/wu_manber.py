"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items, symbols are words, a block is two of them.
For patterns of one length the shift table tells how far the search may jump for the block
that ends at the current word: past every alignment at which no pattern can match. Where
the shift is zero, the bucket of that last block has the candidates and a direct
comparison decides. With windows of 13 words a search looks at about one block in twelve.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.arrow import extend, texts
from gradus.llm.staging import Stage

#: Words of benchmark text whose windows are sent to the tasks at once.
BLOCK_WORDS = 1_000_000

# Bytes of words: digits, a-z and all of non-ASCII; A-Z as a-z, others as a blank.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


class Patterns:
    """Search tables for word windows of one length."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], set[str]]):
        self.length = length
        self.size = min(2, length)  # words in a block
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for window, items in windows.items():
            for end in range(self.size, length + 1):
                block = window[end - 1] if self.size == 1 else window[end - 2 : end]
                distance = length - end
                self.shift[block] = min(distance, self.shift.get(block, distance))
            self.buckets[block].append((list(window), items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(start, items) of every occurrence, in order."""
        length, shift, buckets = self.length, self.shift, self.buckets
        jump = length - self.size + 1
        pairs = self.size == 2
        at, last = length - 1, len(words)
        while at < last:
            block = (words[at - 1], words[at]) if pairs else words[at]
            step = shift.get(block, jump)
            if not step:
                start = at - length + 1
                for window, items in buckets[block]:
                    if words[start : at + 1] == window:
                        yield start, items
                step = 1
            at += step


def windows_of(items: Iterable[tuple[str, str]], window: int) -> list[Patterns]:
    """Search tables of the items (id, text), one for each length that occurs."""
    found: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for name, text in items:
        words = words_of(text)
        length = min(window, len(words))
        for start in range(len(words) - length + 1 if words else 0):
            found[length][tuple(words[start : start + length])].add(name)
    return [Patterns(length, dict(windows)) for length, windows in sorted(found.items())]


def _search(items: list[tuple[str, str]], column: str, window: int):
    tables: list[list[Patterns]] = []

    def compute(batch: pa.RecordBatch) -> list[list]:
        if not tables:  # once in a task
            tables.append(windows_of(items, window))
        counts, spans, named = [], [], []
        for text, old, known in zip(
            texts(batch, column), batch.column("_spans").to_pylist(), batch.column("_items").to_pylist(),
            strict=True,
        ):
            words = words_of(text)
            hits = [(old[i], old[i + 1]) for i in range(0, len(old), 2)]
            found = set(known)
            for patterns in tables[0]:
                low = high = -1
                for start, names in patterns.search(words):
                    if start > high:
                        if high > low:
                            hits.append((low, high))
                        low = start
                    high = start + patterns.length
                    found |= names
                if high > low:
                    hits.append((low, high))
            counts.append(len(words))
            spans.append([x for hit in _merged(hits) for x in hit])
            named.append(sorted(found))
        return [counts, spans, named]

    return compute


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    share: int = 20,
) -> DataFrame:
    """``df`` plus ``n_words``, ``n_hit``, ``hit_spans``, ``items`` and ``contaminated``.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. A
    window is ``window`` consecutive words of an item, or all of an item that has fewer. A
    word inside any occurrence of a window is hit; ``hit_spans`` are the hit runs (start,
    end) counted in words, ``items`` the ids, as strings, of items with occurring windows.
    Contaminated: some word is hit, and ``share`` * n_hit >= n_words.

    Items are taken in blocks of about BLOCK_WORDS words, one pass over ``df`` each without a
    shuffle and written before the next, so what goes through the driver and to the tasks
    at once is bounded.
    NULL and empty texts have no words, items without words no window. An item without an
    id counts with an empty id; equal items count each. Columns of ``df`` by the new names
    are replaced, others stay, whatever their names; empty tables give empty results.
    """
    added = ["n_words", "n_hit", "hit_spans", "items", "contaminated"]
    body = df[f"`{text_column}`"].alias("body")
    # The caller's columns travel as one, so that none can be mistaken for one of these.
    kept = [df[f"`{c}`"] for c in df.columns if c not in added]
    df = df.select(F.struct(*kept).alias("row") if kept else F.lit(None).alias("row"), body)
    columns = df.columns
    item = benchmark.where(F.col(item_text).isNotNull()).select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("name"),
        F.col(item_text).alias("body"),
    )
    chars = item.agg(F.sum(F.char_length("body"))).first()[0] or 0
    blocks = 1 + chars // (4 * BLOCK_WORDS)
    out = df.withColumns(
        {"_spans": F.array().cast("array<int>"), "_items": F.array().cast("array<string>"), "_n": F.lit(0)}
    )
    stage = Stage(df.sparkSession)
    for block in range(blocks):
        if block:
            # One block's items and tables at a time; the next pass reads what this one found.
            done, out = out, stage.write(out)
            if block > 1:
                stage.drop(done)
        part = item.where(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == block)
        rows = [(r.name, r.body) for r in part.toLocalIterator()]
        made = extend(out, "n0 int, s0 array<int>, i0 array<string>", _search(rows, "body", window))
        out = made.select(
            *columns, F.col("s0").alias("_spans"), F.col("i0").alias("_items"), F.col("n0").alias("_n")
        )
    places = F.sequence(F.lit(0), F.size("_spans") - 2, F.lit(2))
    spans = F.when(
        F.size("_spans") > 0,
        F.transform(places, lambda i: F.struct(
            F.get("_spans", i).alias("start"), F.get("_spans", i + 1).alias("end"))),
    ).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
    out = out.withColumn("hit_spans", spans)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = out.withColumns({"n_words": F.col("_n").cast("long"), "n_hit": hit, "items": F.col("_items")})
    guilty = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return out.withColumn("contaminated", guilty).select(*(["row.*"] if kept else []), *added)

