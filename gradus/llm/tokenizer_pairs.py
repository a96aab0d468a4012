"""Two tokenizers over the same texts: where their tokens end together, and how often.

Links are the pairs of a token of A and a token of B that end at the same byte. A link's count
is how many links of the whole corpus join the same two ids, so every document needs
counts that all others made. They are counted by spilling, like an external sort:

1. Texts are encoded once. The links of some megabytes of texts become records (pair of ids,
   document, times), are dealt by the radix of their B id and written as sorted runs packed
   with zstd: the distinct pairs with their counts apart from the documents that hold them.
2. For each radix, a heap merges the pairs of its runs in order. A radix with many runs is
   merged in slices of bounded size first, and the slices' results are merged again.
3. Pairs are ordered by their B id, so where the B id changes the highest count is known.
4. The totals of a radix go to its runs, slice by slice, and each run streams what
   its documents get back to the texts it was made of.

So no group grows with the number of documents: a pair that every document holds is one
entry of each run. Totals are bounded by the two vocabularies.

Both tokenizers part a text before a space that follows a non-space: A by its pattern, B since
no piece has a space after another character. Words so parted are encoded one by one and
remembered, which is the encoding of the whole text.
"""

from __future__ import annotations

import heapq
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gradus.llm.staging import Stage

#: Parts of the B ids.
RADIXES = 32
#: Bytes of text in the runs of one batch, and texts in it at most.
BATCH_BYTES, BATCH_TEXTS = 8 << 20, 1 << 16
#: Packed bytes of runs that one task merges at once, and results merged at once after that.
SLICE_BYTES, FAN = 32 << 20, 64
#: Words remembered by one worker, in each of two generations, and the longest of them.
WORDS, LONGEST = 100_000, 64
#: New words encoded in one text.
SIDE_BY_SIDE = 200

_PARTS = re.compile(r"(?<=\S)(?= [\s\S])").split
_SHIFT = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers as bytes: each in the smallest width, then zstd."""
    parts = []
    for a in arrays:
        width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(a) or int(a.max()) < 1 << 8 * w)
        parts.append(np.array([width, len(a)], dtype="<u8").tobytes() + a.astype(f"<u{width}").tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(packed: bytes) -> list[np.ndarray]:
    whole, at, arrays = zstandard.ZstdDecompressor().decompress(packed), 0, []
    while at < len(whole):
        width, n = np.frombuffer(whole, "<u8", 2, at).tolist()
        arrays.append(np.frombuffer(whole, f"<u{width}", n, at + 16).astype(np.uint64))
        at += 16 + width * n
    return arrays


class Words:
    """Words with the tokens of both sides, found once each."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        byte = re.compile(r"<0x([0-9A-F]{2})>").fullmatch
        self.b_bytes = [
            bytes([int(m[1], 16)]) if (m := byte(p)) else p.replace("▁", " ").encode() for p in pieces
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        # How an id is written: of A before a comma and before the bar, of B before a comma and the next group.
        n, m = len(self.a_bytes), len(pieces)
        self.written = [f"{i}{mark}" for size, mark in ((n, ","), (n, "|"), (m, ","), (m, ";")) for i in range(size)]
        # Words may be encoded one by one only if no piece goes on after a space.
        self.whole = any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def parts(self, text: str) -> list[str]:
        return [" " + text] if self.whole else _PARTS(" " + text)

    def look_up(self, parts: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids of A and of B for each part, empty where its bytes are not given back."""
        found = list(map(self.known.get, parts))
        new = []
        for i, value in enumerate(found):
            if value is None:
                found[i] = value = self.older.get(parts[i])
                if value is None:
                    new.append(i)
                else:
                    self._keep(parts[i], value)
        # Words that end with a letter or sign are encoded side by side: their bounds stay token ends.
        plain = [i for i in new if not parts[i][-1].isspace()]
        odd = [i for i in new if parts[i][-1].isspace()]
        for start in range(0, len(plain), SIDE_BY_SIDE):
            some = plain[start : start + SIDE_BY_SIDE]
            made = self._together([parts[i] for i in some])
            if made is None:
                odd += some
            else:
                for i, value in zip(some, made, strict=True):
                    found[i] = value
        for i in odd:
            found[i] = self._alone(parts[i])
        for i in new:
            if len(parts[i]) <= LONGEST:
                self._keep(parts[i], found[i])
        return found

    def _ids(self, text: str) -> list[tuple[list[int], list[bytes]]]:
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode([text[1:]], num_threads=1)[0]
        return [(a, self.a_bytes), (b, self.b_bytes)]

    def _alone(self, part: str) -> tuple[bytes, bytes]:
        raw, sides = part.encode(), self._ids(part)
        if any(b"".join([table[i] for i in ids]) != raw for ids, table in sides):
            return b"", b""
        return tuple(array("I", ids).tobytes() for ids, _ in sides)

    def _together(self, parts: list[str]) -> list[tuple[bytes, bytes]] | None:
        """The words' ids from one text of them all; None if its bytes are not given back."""
        raw = [p.encode() for p in parts]
        whole, bounds = b"".join(raw), np.cumsum([len(r) for r in raw])
        cut = []
        for (ids, table), sizes in zip(self._ids("".join(parts)), (self.a_sizes, self.b_sizes), strict=True):
            if b"".join(map(table.__getitem__, ids)) != whole:
                return None
            numbers = np.array(ids, dtype=np.uint32)
            ends = np.cumsum(sizes[numbers])
            at = np.searchsorted(ends, bounds)
            if not np.array_equal(ends[at], bounds):
                return None
            packed, places = numbers.tobytes(), [0, *((at + 1) * 4).tolist()]
            cut.append([packed[x:y] for x, y in zip(places, places[1:], strict=False)])
        return list(zip(*cut, strict=True))

    def _keep(self, part: str, value: tuple[bytes, bytes]) -> None:
        if len(self.known) >= WORDS:
            self.older, self.known = self.known, {}
        self.known[part] = value


class _Aligned:
    """Different words with their tokens cut into groups, all of them at once.

    Words lie one after the other, so that all token ends are places in one text.
    """

    def __init__(self, own: Words, parts: list[str]):
        rows = own.look_up(parts)
        sides = [np.frombuffer(b"".join([r[k] for r in rows]), np.uint32).astype(np.int64) for k in (0, 1)]
        self.n_a, self.n_b = (np.array([len(r[k]) >> 2 for r in rows], dtype=np.int64) for k in (0, 1))
        a, b = sides
        ends_a, ends_b = np.cumsum(own.a_sizes[a]), np.cumsum(own.b_sizes[b])
        cut_a, cut_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        links = b[cut_b].astype(np.uint64) << _SHIFT | a[cut_a].astype(np.uint64)
        # Tokens in the order they are written: group by group, A before B.
        n, m = len(own.a_bytes), len(own.b_bytes)
        written = np.concatenate([a + n * cut_a, 2 * n + b + m * cut_b])
        groups = [np.cumsum(cut) - cut for cut in (cut_a, cut_b)]
        written = written[np.argsort(np.concatenate([groups[0] * 2, groups[1] * 2 + 1]), kind="stable")]
        self.written = _Rows(written, self.n_a + self.n_b)
        before = np.concatenate([[0], np.cumsum(cut_a)])
        ends = np.cumsum(self.n_a)
        self.links = _Rows(links, before[ends] - before[ends - self.n_a])
        self.good = self.n_a > 0


class _Rows:
    """Rows of different sizes that lie side by side."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.sizes = values, sizes
        self.starts = np.cumsum(sizes) - sizes

    def take(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the chosen rows, one after the other, and where each row's end."""
        wanted = self.sizes[chosen]
        ends = np.cumsum(wanted)
        at = np.repeat(self.starts[chosen] - ends + wanted, wanted) + np.arange(wanted.sum())
        return self.values[at], ends


def _byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def words(a_path: str, b_path: str) -> Words:
    """One for each worker process."""
    return Words(a_path, b_path)


class _Batch:
    """Texts encoded so far, and their links as (word, document)."""

    def __init__(self, number: int):
        self.number = number
        self.size = 0
        self.rows: list[tuple] = []
        self.links: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []

    def add(self, own: Words, ids: list, texts: list[str]) -> None:
        cut = [own.parts(t) if t else [] for t in texts]
        numbers = {part: i for i, part in enumerate(dict.fromkeys(chain.from_iterable(cut)))}
        aligned = _Aligned(own, list(numbers))
        words = np.fromiter(map(numbers.__getitem__, chain.from_iterable(cut)), np.int64)
        links, link_ends = aligned.links.take(words)
        told, told_ends = aligned.written.take(words)
        sums = [np.concatenate([[0], np.cumsum(n[words])]) for n in (aligned.n_a, aligned.n_b, ~aligned.good)]
        link_ends, told_ends = (np.concatenate([[0], e]) for e in (link_ends, told_ends))
        written, end = own.written.__getitem__, 0
        for i, parts in zip(ids, cut, strict=True):
            start, end = end, end + len(parts)
            n_a, n_b, bad = (int(s[end] - s[start]) for s in sums)
            if bad or not parts:
                self.rows.append((i, 0, 0, 0, 0, ""))
                continue
            own_links = links[link_ends[start] : link_ends[end]]
            text = "".join(map(written, told[told_ends[start] : told_ends[end]].tolist()))
            self.links.append(own_links)
            self.docs.append(np.full(len(own_links), len(self.rows), dtype=np.uint32))
            digest = sha256(text[:-1].encode()).hexdigest()
            self.rows.append((i, n_a, n_b, len(own_links), len(own_links), digest))
        self.size += sum(map(len, texts))

    def runs(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(radix, pairs, documents): the pairs sorted, their documents in the same order."""
        if not self.links:
            return
        links, docs = np.concatenate(self.links), np.concatenate(self.docs)
        part = radix(links)
        for r in range(RADIXES):
            mine = part == r
            if not mine.any():
                continue
            key, doc = links[mine], docs[mine]
            order = np.argsort(key, kind="stable")  # documents are in order already
            key, doc = key[order], doc[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
            times = np.diff(first, append=len(key))
            key, doc = key[first], doc[first]
            head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            holders = np.diff(head, append=len(key))
            pairs = _pairs(key[head], np.add.reduceat(times, head))
            yield r, pairs, _pack(holders, doc, times)


def radix(pairs: np.ndarray) -> np.ndarray:
    """Spreads neighbouring B ids, and keeps all pairs of one together."""
    return ((pairs >> _SHIFT) * np.uint64(0x9E3779B1) & _LOW) * np.uint64(RADIXES) >> _SHIFT


def _pairs(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs as steps of the B id, and A ids."""
    return _pack(np.diff(keys >> _SHIFT, prepend=np.uint64(0)), keys & _LOW, counts)


def _keys(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, low, counts = _unpack(packed)
    return np.cumsum(steps, dtype=np.uint64) << _SHIFT | low, counts


_ENCODED = """batch long, place int, id {id}, n_a long, n_b long, n_groups long, n_links long,
    groups_sha256 string, radix int, pairs binary, holders binary"""


def _encode(df: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each text, and after each batch of texts one for each of its runs."""
    kind = df.schema["id"].dataType
    id_type = to_arrow_type(kind)
    fields = _ENCODED.format(id=kind.simpleString())
    names = [f.split()[0] for f in fields.split(",")]

    def told(batch: _Batch) -> Iterator[pa.RecordBatch]:
        n = len(batch.rows)
        columns = list(zip(*batch.rows, strict=True))
        types = [id_type, *[pa.int64()] * 4, pa.string()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([batch.number] * n, pa.int64()),
                pa.array(range(n), pa.int32()),
                *[pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                *[pa.nulls(n, t) for t in (pa.int32(), pa.binary(), pa.binary())],
            ],
            names=names,
        )
        for r, pairs, holders in batch.runs():
            row = [batch.number, *[None] * 7, r, pairs, holders]
            types = [pa.int64(), pa.int32(), id_type, *[pa.int64()] * 4, pa.string()]
            types += [pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base = words(a_path, b_path), TaskContext.get().partitionId() << 32
        open_batch = _Batch(base)
        for whole in batches:
            start = 0
            lengths = [len(t) if t else 0 for t in whole.column("body").to_pylist()]
            while start < whole.num_rows:
                # About a megabyte of words at a time.
                end, size = start, 0
                while end < whole.num_rows and (end == start or size + lengths[end] <= 1 << 20):
                    size, end = size + lengths[end], end + 1
                part = whole.slice(start, end - start)
                texts = [t or "" for t in part.column("body").to_pylist()]
                open_batch.add(own, part.column("id").to_pylist(), texts)
                start = end
                if open_batch.size >= BATCH_BYTES or len(open_batch.rows) >= BATCH_TEXTS:
                    yield from told(open_batch)
                    open_batch = _Batch(open_batch.number + 1)
        if open_batch.rows:
            yield from told(open_batch)

    return df.mapInArrow(run, fields)


def _merged(table: pa.Table) -> bytes:
    """The runs' pairs merged by a heap, counts of equal ones added up."""
    runs = [_keys(p) for p in table.column("pairs").to_pylist()]
    keys: list[int] = []
    counts: list[int] = []
    last = -1
    for key, count in heapq.merge(*[zip(k.tolist(), c.tolist(), strict=True) for k, c in runs]):
        if key == last:
            counts[-1] += count
        else:
            keys.append(key)
            counts.append(count)
            last = key
    return _pairs(np.array(keys, dtype=np.uint64), np.array(counts, dtype=np.uint64))


def _merge(runs: DataFrame) -> DataFrame:
    """(radix, slice, pairs): one run for each slice."""

    def run(table: pa.Table) -> pa.Table:
        head = [pa.array(table.column(c)[:1].to_pylist(), pa.int32()) for c in ("radix", "slice")]
        return pa.table([*head, pa.array([_merged(table)], pa.binary())], names=["radix", "slice", "pairs"])

    grouped = runs.select("radix", "slice", "pairs").groupBy("radix", "slice")
    return grouped.applyInArrow(run, "radix int, slice int, pairs binary")


def _contributions(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """For each run (batch, best, sums): what its documents get from this radix."""
    keys, counts = _keys(totals.column("pairs")[0].as_py())
    # In the order of B ids, each id's pairs lie side by side.
    heads = np.flatnonzero(np.r_[True, keys[1:] >> _SHIFT != keys[:-1] >> _SHIFT])
    highest = np.repeat(np.maximum.reduceat(counts, heads), np.diff(heads, append=len(keys)))
    best = (counts == highest).astype(np.uint64)
    out: list[list] = [[], [], []]
    columns = [runs.column(c).to_pylist() for c in ("batch", "pairs", "holders")]
    for batch, pairs, holders in zip(*columns, strict=True):
        mine, _ = _keys(pairs)
        at = np.searchsorted(keys, mine)
        held, doc, times = _unpack(holders)
        at, doc = np.repeat(at, held.astype(np.int64)), doc.astype(np.int64)
        for column, value in zip(out[1:], (best, counts), strict=True):
            sums = np.zeros(int(doc.max()) + 1, dtype=np.uint64)
            np.add.at(sums, doc, times * value[at])
            column.append(_pack(sums))
        out[0].append(batch)
    types = [pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=["batch", "best", "sums"])


def _finish(docs: pa.Table, parts: pa.Table) -> pa.Table:
    """The rows of a batch with the sums over all radixes."""
    totals = np.zeros((2, docs.num_rows), dtype=np.uint64)
    for row, name in enumerate(("best", "sums")):
        for packed in parts.column(name).to_pylist():
            values = _unpack(packed)[0]
            totals[row, : len(values)] += values
    place = docs.column("place").to_numpy()
    found = [pa.array(t[place].astype(np.int64), pa.int64()) for t in totals]
    return docs.drop_columns(["batch", "place"]).append_column("n_best", found[0]).append_column("count_sum", found[1])


def align(df: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``).

    ``a_path`` is a byte-level BPE file (space + text is encoded), ``b_path`` a piece model that
    adds the space itself; both are files every executor can read. ``n_best`` are the links
    whose count is the highest of their B id, ``count_sum`` adds the counts of all links, and
    the digest is of the groups ``a1,a2|b1;a3|b2,b3``.

    One row for each row of ``df``: repeated rows are encoded and counted each, ids may be
    NULL or equal. Texts that are NULL or empty, or that either side's tokens do not give
    back byte by byte, have no tokens: zeros and ''. Texts of any length are encoded whole.
    Further columns of ``df`` are not read, whatever their names; an empty table gives an
    empty one.
    """
    stage = Stage(df.sparkSession)
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    made = stage.write(_encode(source, a_path, b_path))
    docs = made.where("radix IS NULL").drop("radix", "pairs", "holders")
    runs = made.where("radix IS NOT NULL").select("batch", "radix", "pairs", "holders")
    # One number for each radix.
    sizes = runs.groupBy("radix").agg(F.sum(F.length("pairs") + F.length("holders")).alias("size")).collect()
    slices = [1] * RADIXES
    for r in sizes:
        slices[r["radix"]] = -(-r["size"] // SLICE_BYTES)
    parts = F.element_at(F.array(*map(F.lit, slices)), F.col("radix") + 1)
    runs = runs.withColumn("slice", F.pmod(F.xxhash64("batch"), parts).cast("int"))
    totals, left = stage.write(_merge(runs)), max(slices)
    while left > 1:
        totals = stage.write(_merge(totals.withColumn("slice", (F.col("slice") / FAN).cast("int"))))
        left = -(-left // FAN)
    spread = totals.select("radix", "pairs", F.explode(F.sequence(F.lit(0), parts - 1)).alias("slice"))
    given = runs.groupBy("radix", "slice").cogroup(spread.groupBy("radix", "slice"))
    given = stage.write(given.applyInArrow(_contributions, "batch long, best binary, sums binary"))
    result = [f for f in docs.schema.fields if f.name not in ("batch", "place")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in result) + ", n_best long, count_sum long"
    done = docs.groupBy("batch").cogroup(given.groupBy("batch")).applyInArrow(_finish, schema)
    return done.select(
        F.col("id").alias(id_column), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
