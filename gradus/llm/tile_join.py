"""Links of documents whose sets of word shingles are alike, by tiles and bitmaps.

Two sets x, y with |x & y| * 100 >= percent * |x | y| differ in size by that share at most, and
share a shingle among the first |x| - ceil(percent * |x| / 100) + 1 of each, in any one order
of all shingles. The order here is rare shingles first, so passages that many documents hold
bring nobody together; how frequent a shingle is, is read off a table of 2**23 counters that
all documents fill, so its size is fixed: what a counter holds beyond the usual is a frequent
shingle's. The order decides how many tiles there are, never which links are found.

Documents with equal sets are one class with one representative. The representatives that
share a prefix shingle make a bucket:

1. Every member is compared with the bucket's smallest and largest member, which joins the
   copies of one text without pairing them with each other.
2. Buckets that still hold several components are cut into tiles: bands of size, each band
   into parts of bounded size. A tile meets the tiles of its own and the neighbouring bands.
   The bucket's largest component has tiles of its own, which never meet each other, so a
   great group of near copies costs its outsiders times its size, not its square.

Every set has a bitmap of about as many bits as shingles, each the parity of the shingles
hashed to it. A bitmap is folded to half its width by parity again, so two of different
widths compare. The bits in which two bitmaps differ are at most the shingles in which the
sets differ, so

    |x & y| <= (|x| + |y| - bits) / 2

and a pair whose bound is too low is not alike. Only what the bound lets through is compared
exactly, as sorted arrays of 64-bit numbers. Nothing is missed by any step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.arrow import extend, pieces, texts
from gradus.llm.components import components
from gradus.llm.shingles import forget, mix, overlap, shingle_sets
from gradus.llm.staging import Stage

#: Counters of shingles, and the parts they are added up in.
CELLS, CHUNKS = 1 << 23, 32
#: Bits of a bitmap at least; beyond, the power of two from the set's size on.
BITS = 512
#: Members of a tile, and shingles in their sets together, at most (one member at least).
TILE, TILE_SHINGLES = 1024, 1 << 21
#: Pairs for each member up to which a meeting gives pairs.
FEW = 2
#: A class of copies with this share of all rows is dealt to SALTS keys; so there are few.
HOT_SHARE, SALTS = 1000, 32
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _needed(percent: int, size: int | np.ndarray) -> int | np.ndarray:
    """ceil(percent * size / 100)."""
    return -(-percent * size // 100)


def _counters(source: DataFrame, width: int) -> np.ndarray:
    """For each cell how much it holds, on a logarithmic scale round the usual."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, dtype=np.int32)
        for batch in batches:
            values = [t.encode() for t in texts(batch, "body")]
            for start, end in pieces(values):
                np.add.at(cells, _cells(np.concatenate(shingle_sets(values[start:end], width))), 1)
        if cells.any():
            yield _chunks(cells)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = _numbers(packed)
                sums[chunk] = sums[chunk] + mine if chunk in sums else mine
        if sums:
            rows = sorted(sums.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in rows], pa.int32()), pa.array([_packed(v) for _, v in rows], pa.binary())],
                names=["chunk", "cells"],
            )

    fields = "chunk int, cells binary"
    parts = source.select("body").mapInArrow(count, fields)
    # CHUNKS rows, of 64 MB together at most before packing.
    rows = parts.repartition(CHUNKS, "chunk").mapInArrow(add, fields).collect()
    found = np.zeros((CHUNKS, CELLS // CHUNKS), dtype=np.int64)
    for r in rows:
        found[r["chunk"]] = _numbers(r["cells"])
    # Every count has its place, so a passage of a few documents comes after what only one has.
    usual = float(np.median(found))
    return np.clip(128 + 24 * np.log2((found.ravel() + 1) / (usual + 1)), 0, 255).astype(np.uint8)


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype(np.int64).tobytes())


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int64)


def _chunks(cells: np.ndarray) -> pa.RecordBatch:
    rows = [_packed(part) for part in cells.reshape(CHUNKS, -1)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(CHUNKS), pa.int32()), pa.array(rows, pa.binary())], names=["chunk", "cells"]
    )


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(41)).astype(np.int64)


def bitmap(shingles: np.ndarray) -> bytes:
    """The parities of the shingles in each of its places."""
    places = max(BITS, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else BITS
    at = (mix(shingles ^ _GOLD) & np.uint64(places - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=places) & 1).astype(bool)).tobytes()


def _folded(packed: bytes, width: int) -> np.ndarray:
    """The bitmap in ``width`` bytes, as 64-bit numbers."""
    bits = np.frombuffer(packed, np.uint64)
    while bits.nbytes > width:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _may_be_alike(differ: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether the overlap can be enough, by the differing bits and the sizes added up."""
    return (100 + percent) * ((both - differ) >> 1) >= percent * both


def prefix(shingles: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in the common order, as many as two alike sets must share one of."""
    order = np.lexsort((shingles, levels[_cells(shingles)]))
    return shingles[order[: len(shingles) - _needed(percent, len(shingles)) + 1]]


def _describe(width: int, percent: int, levels: np.ndarray):
    def compute(batch: pa.RecordBatch) -> list[list]:
        values = [t.encode() for t in texts(batch, "body")]
        out: list[list] = [[], [], [], [], []]
        for start, end in pieces(values):
            for s in shingle_sets(values[start:end], width):
                out[0].append(len(s))
                out[1].append(int(mix(s + _GOLD).sum(dtype=np.uint64).view(np.int64)))
                out[2].append(int(np.bitwise_xor.reduce(mix(s ^ _GOLD)).view(np.int64)))
                out[3].append(bitmap(s))
                out[4].append(prefix(s, levels, percent).view(np.int64) if len(s) else [])
        return out

    return compute


def _grouped(links: DataFrame) -> DataFrame:
    """(node, component): nodes of one component are connected, though not all connected ones
    have the same. Two steps of taking the smallest neighbour, enough for groups round a hub."""
    both = links.select(F.col("hub").alias("u"), F.col("id").alias("v"))
    both = both.union(links.select(F.col("id").alias("u"), F.col("hub").alias("v")))
    near = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    beyond = both.join(near.select(F.col("u").alias("v"), "m"), "v").groupBy("u").agg(F.min("m").alias("far"))
    return near.join(beyond, "u").select(F.col("u").alias("node"), F.least("m", "far").alias("component"))


def _likely_among(rows: DataFrame, some: DataFrame) -> DataFrame:
    """The ``rows`` whose id may be in ``some``: a table of 2**23 bits, whatever their number,
    is broadcast, so that few other texts are shuffled for the exact join that follows."""
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 23))
    bit = F.expr("shiftleft(1L, CAST(_place % 64 AS INT))")
    marked = some.withColumn("_place", place).groupBy(F.shiftright("_place", 6).alias("_word"))
    # 2**17 rows at most.
    words = F.broadcast(marked.agg(F.bit_or(bit).alias("_bits")))
    placed = rows.withColumn("_place", place).withColumn("_word", F.shiftright("_place", 6)).join(words, "_word")
    return placed.where(F.col("_bits").bitwiseAND(bit) != 0).select(rows.columns)


def _sizes_fit(x: str, y: str, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = overlap(x, y)
    return 100 * common >= percent * (len(x) + len(y) - common)


def _with_hub(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """``pairs`` (hub, id, ...) with ``facts`` of both; a hub's rows are dealt to SALTS keys."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    named = {c: f"hub_{c}" for c in facts.columns if c != "id"}
    own = facts.select(F.col("id").alias("hub"), *[F.col(c).alias(n) for c, n in named.items()])
    hubs = salted.select("hub", "salt").distinct().join(own, "hub")
    return salted.join(facts, "id").join(hubs, ["hub", "salt"]).drop("salt")


def _bounded(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (hub, id) that sizes and bitmaps let through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = np.empty(batch.num_rows, dtype=np.int64)
            for i, (x, y) in enumerate(zip(batch.column("bits"), batch.column("hub_bits"), strict=True)):
                x, y = x.as_py(), y.as_py()
                width = min(len(x), len(y))
                differ[i] = np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum(dtype=np.int64)
            both = batch.column("n").to_numpy() + batch.column("hub_n").to_numpy()
            keep = _may_be_alike(differ, both, percent)
            yield batch.select(["hub", "id"]).filter(pa.array(keep, pa.bool_()))

    both = _with_hub(pairs, bits).where(_sizes_fit("n", "hub_n", percent))
    return both.select("hub", "id", "n", "hub_n", "bits", "hub_bits").mapInArrow(run, "hub long, id long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (hub, id) whose sets are alike enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, theirs = batch.column("shingles"), batch.column("hub_shingles")
            keep = [
                _alike(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(mine, theirs, strict=True)
            ]
            yield batch.select(["hub", "id"]).filter(pa.array(keep, pa.bool_()))

    both = _with_hub(pairs, sets).select("hub", "id", "shingles", "hub_shingles")
    return both.mapInArrow(run, "hub long, id long")


_TILE = ["key", "band", "core", "part"]
_PAIR = ["key", "band", "part", "other_band", "other_core", "other_part"]


def _tile_pairs(live: DataFrame) -> DataFrame:
    """The members of ``live`` (key, id, n, comp, core, band) once for each meeting of their tile.

    ``first`` and ``second`` tell on which side of the meeting a member stands.
    """
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum("n") / TILE_SHINGLES)).cast("int")
    tiles = live.groupBy("key", "band", "core").agg(parts.alias("parts"))
    members = live.join(tiles, ["key", "band", "core"])
    members = members.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
    each = tiles.select("key", "band", "core", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    others = each.select("key", *[F.col(c).alias(f"other_{c}") for c in _TILE[1:]])
    near = F.abs(F.col("other_band") - F.col("band")) <= 1
    later = F.struct("other_band", "other_part") >= F.struct("band", "part")
    meetings = each.where("NOT core").join(others, "key").where(near & (F.col("other_core") | later))
    same = ~F.col("other_core") & (F.col("other_band") == F.col("band")) & (F.col("other_part") == F.col("part"))
    meetings = meetings.withColumn("alone", same)
    left = members.where("NOT core").join(meetings, _TILE)
    left = left.select(*_PAIR, "id", "n", "comp", F.lit(True).alias("first"), F.col("alone").alias("second"))
    mine = [F.col(c).alias(f"other_{c}") for c in _TILE[1:]]
    right = members.select("key", *mine, "id", "n", "comp").join(
        meetings.where("NOT alone"), ["key", "other_band", "other_core", "other_part"]
    )
    right = right.select(*_PAIR, "id", "n", "comp", F.lit(False).alias("first"), F.lit(True).alias("second"))
    return left.unionByName(right)


class _Meeting:
    """The members of two tiles, and the pairs that the bitmaps let through."""

    def __init__(self, table: pa.Table, percent: int):
        self.percent = percent
        self.ids, self.sizes, self.comp = (table.column(c).to_numpy() for c in ("id", "n", "comp"))
        # Sizes of neighbouring bands, so widths differ by a factor of two at most.
        bits = table.column("bits").to_pylist()
        width = min(map(len, bits))
        self.bits = np.stack([_folded(b, width) for b in bits])
        self.first, self.second = (np.flatnonzero(table.column(c).to_numpy()) for c in ("first", "second"))
        self.alone = bool(np.isin(self.first, self.second).any())

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """(member, those it may be alike, in other components)."""
        for i in self.first.tolist():
            others = self.second[self.comp[self.second] != self.comp[i]]
            if self.alone:
                others = others[others > i]
            differ = np.bitwise_count(self.bits[others] ^ self.bits[i]).sum(axis=1, dtype=np.int64)
            others = others[_may_be_alike(differ, self.sizes[others] + self.sizes[i], self.percent)]
            if len(others):
                yield i, others


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each meeting, which lie side by side; no more than one meeting is held."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        if not len(table):
            continue
        new = np.zeros(len(table), dtype=bool)
        for column in _PAIR:
            values = table.column(column).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield table.slice(start, end - start)
        held = table.slice(cuts[-1])
    if held is not None and len(held):
        yield held


def _side_by_side(met: DataFrame) -> DataFrame:
    return met.repartition(*_PAIR).sortWithinPartitions(*_PAIR)


def _open(met: DataFrame, percent: int) -> DataFrame:
    """What the bitmaps let through, as pairs or as members.

    A meeting with few such pairs for its size gives the pairs (``hub`` and ``id``), since
    the same ones come from many buckets. One with many gives its members that take part
    (``hub`` is NULL), which are compared with their sets side by side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _one_by_one(batches):
            found = list(_Meeting(table, percent).pairs())
            if not found:
                continue
            n = sum(len(others) for _, others in found)
            ids = table.column("id").to_numpy()
            if n <= FEW * len(table):
                rows = np.repeat([i for i, _ in found], [len(others) for _, others in found])
                hub = pa.array(ids[np.concatenate([others for _, others in found])])
            else:
                rows = np.unique(np.concatenate([[i for i, _ in found], *[others for _, others in found]]))
                hub = pa.nulls(len(rows), pa.int64())
            kept = table.take(pa.array(rows.astype(np.int64))).append_column("hub", hub)
            yield from kept.select([*names, "hub"]).combine_chunks().to_batches()

    names = met.columns
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in met.schema.fields)
    return _side_by_side(met).mapInArrow(run, f"{fields}, hub long")


def _linked(met: DataFrame, percent: int) -> DataFrame:
    """Links (hub, id) between components: no more than join those of each meeting."""

    def links(table: pa.Table) -> list[tuple[int, int]]:
        meeting = _Meeting(table, percent)
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("shingles")]
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := above.setdefault(x, x)) != x:
                above[x] = above.get(up, up)
                x = up
            return x

        found = []
        for i, others in meeting.pairs():
            for o in others.tolist():
                x, y = root(int(meeting.comp[i])), root(int(meeting.comp[o]))
                if x != y and _alike(sets[i], sets[o], percent):
                    above[x] = y
                    found.append((int(meeting.ids[i]), int(meeting.ids[o])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _one_by_one(batches):
            if found := links(table):
                ends = [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(ends, names=["hub", "id"])

    return _side_by_side(met).mapInArrow(run, "hub long, id long")


def join_alike(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(id, ``n_shingles``, ``component_id``), one row for each row of ``df``.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their sets of
    distinct shingles of ``shingle_words`` words (fewer words: one shingle of them all).
    ``component_id`` is the smallest id reachable over links.

    NULL, empty and blank texts have the empty set and are linked with nothing. Rows sharing
    an id are one node, linked by whatever any of them is linked by; a blank one among them
    stands for itself. A row without an id takes no part: ``component_id`` is NULL. Texts of
    any length are compared whole. Further columns of ``df`` are not read, whatever their
    names; an empty table gives an empty one. ``id_column`` holds whole numbers and keeps
    its name.
    """
    stage = Stage(df.sparkSession)
    source = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("body"))
    levels = _counters(source, shingle_words)
    fields = "n long, d1 long, d2 long, bits binary, prefix array<long>"
    made = extend(source, fields, _describe(shingle_words, percent, levels), forget).drop("body")
    facts = stage.write(made)
    equal = ["d1", "d2", "n"]
    slim = stage.write(facts.select("id", *equal))
    nodes = slim.where("id IS NOT NULL AND n > 0")
    classes = stage.write(nodes.groupBy(*equal).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows")))
    reps = facts.join(classes.withColumnRenamed("rep", "id"), ["id", *equal], "left_semi")
    reps = reps.groupBy("id", *equal).agg(F.first("bits").alias("bits"), F.first("prefix").alias("prefix"))
    reps = stage.write(reps.select("id", "n", "bits", "prefix"))
    stage.drop(facts)

    entries = reps.select(F.explode("prefix").alias("key"), "id", "n")
    shared = entries.groupBy("key").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("members")
    )
    placed = stage.write(entries.join(shared.where("low < high"), "key"))
    bits = stage.write(reps.select("id", "n", "bits").join(placed.select("id").distinct(), "id", "left_semi"))
    stage.drop(reps)

    def sets_of(some: DataFrame) -> DataFrame:
        some = stage.write(some)
        wanted = _likely_among(source.where("id IS NOT NULL"), some).join(some, "id", "left_semi").distinct()
        return stage.write(extend(wanted, "shingles binary", _shingles(shingle_words), forget).select("id", "shingles"))

    pairs = placed.select(F.explode(F.array("low", "high")).alias("hub"), "id").where("hub <> id").distinct()
    likely = stage.write(_bounded(pairs, bits, percent))
    sets = sets_of(likely.select("id").union(likely.select("hub")).distinct())
    links = stage.write(_confirmed(likely, sets, percent))
    stage.drop(sets)

    # Of three members every pair has met an end.
    found = _grouped(links)
    named = placed.where("members > 3").select("key", "id", "n")
    named = named.join(found, named["id"] == found["node"], "left")
    named = named.select("key", "id", "n", F.coalesce("component", "id").alias("comp"))
    groups = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("size"))
    largest = groups.groupBy("key").agg(F.max_by("comp", F.struct("size", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
    live = named.join(largest.where("comps > 1").select("key", "top"), "key")
    # Alike sizes lie in one band or in neighbouring ones; the base is a little above their ratio.
    band = F.floor(F.log("n") / float(np.log(100 / percent * 1.008))) if percent < 100 else F.col("n")
    live = live.select("key", "id", "n", "comp", (F.col("comp") == F.col("top")).alias("core"), band.cast("int").alias("band"))
    met = _tile_pairs(stage.write(live)).join(bits, ["id", "n"])
    met = stage.write(_open(met, percent))
    few = met.where("hub IS NOT NULL").select(F.least("hub", "id").alias("hub"), F.greatest("hub", "id").alias("id")).distinct()
    many = met.where("hub IS NULL").drop("hub")
    sets = sets_of(met.select("id").union(few.select("hub")).distinct())
    links = links.union(stage.write(_confirmed(few, sets, percent)))
    links = links.union(stage.write(_linked(many.join(sets, "id"), percent)))

    # Rows that share an id but not a set join the classes of their sets.
    several = nodes.groupBy("id").agg(F.min(F.struct(*equal)).alias("x"), F.max(F.struct(*equal)).alias("y"))
    several = nodes.join(several.where("x <> y").select("id"), "id", "left_semi").distinct()
    links = links.union(several.join(classes, equal).select(F.col("rep").alias("hub"), "id"))
    found = components(links, stage)
    whole = classes.join(found, classes["rep"] == found["node"], "left")
    whole = whole.select(*equal, "rows", F.coalesce("component", "rep").alias("component"))
    return _deal_out(slim, whole, equal).select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )


def _shingles(width: int):
    def compute(batch: pa.RecordBatch) -> list[list]:
        values = [t.encode() for t in texts(batch, "body")]
        return [[s.tobytes() for a, b in pieces(values) for s in shingle_sets(values[a:b], width)]]

    return compute


def _deal_out(rows: DataFrame, classes: DataFrame, equal: list[str]) -> DataFrame:
    """``rows`` with the component of their class; the copies of a great class go to SALTS tasks."""
    total = rows.agg(F.count(F.lit(1))).first()[0]
    great = F.col("rows") * HOT_SHARE >= total
    # HOT_SHARE rows at most.
    hot = F.broadcast(classes.where(great).select(*equal, F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    rows = rows.join(hot, equal, "left").withColumn("salt", salt)
    salts = F.when(great, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    classes = classes.select(*equal, "component", F.explode(salts).alias("salt"))
    return rows.join(classes, [*equal, "salt"], "left")
