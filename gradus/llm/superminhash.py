"""Near-duplicate documents: SuperMinHash signatures, banding, exact checks, union-find.

Every distinct shingle of a document draws one rank for each signature slot from a random
permutation of the slots, so the ranks of one element are correlated: all slots are filled
evenly, which lowers the variance of the estimate. Elements take their permutation one
step at a time, all at once; a value drawn at step j lies in [j, j + 1), so as soon as
every slot is filled no later step can change anything and the document stops. Long
documents need one step.

Documents with equal shingle sets are one class from the start. Class representatives meet
in the buckets of their bands, and every link is confirmed on the full sets, without
emitting the pairs within a group:

1. Each bucket's members are compared with its smallest and its largest member.
2. Buckets that still join several components are cut into blocks, and pairs of blocks are
   worked on apart. Signatures tell which members have a partner in another component that
   may be alike enough; the texts of those only are brought to the block, which compares
   all such pairs exactly and gives back no more links than join its components.

A pair is looked at in the first of its common buckets only, and no task holds a whole large
bucket. With 32 bands of 4 slots a pair at a
likeness of 0.8 meets in no bucket with probability below 1e-7; a true link is missed by
the signature test of step 2 only beyond 4 standard deviations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.arrow import extend, pieces, texts
from gradus.llm.components import components
from gradus.llm.shingles import forget, mix, overlap, shingle_sets
from gradus.llm.staging import Stage

SLOTS, BANDS = 128, 32
#: Members of a bucket in one block.
BLOCK = 1024
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set, one row of ``slots`` numbers; an empty set has _EMPTY."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.full(len(sets) * slots, _EMPTY, dtype=np.uint64)
    elements = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order: np.ndarray | None = None  # slots not yet drawn, from position j on
    for j in range(slots):
        if not len(elements):
            break
        drawn = mix(elements + np.uint64((j + 1) * int(_GOLD) % (1 << 64)))
        k = j + (((drawn & _LOW) * np.uint64(slots - j)) >> _HALF).astype(np.int64)
        if j:
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
                first = mix(elements + _GOLD)
                taken = (((first & _LOW) * np.uint64(slots)) >> _HALF).astype(np.int64)
                order[np.arange(len(elements)), taken] = 0
            rows = np.arange(len(elements))
            slot = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
        else:
            slot = k
        np.minimum.at(out, owner * slots + slot, (np.uint64(j) << _HALF) | (drawn >> _HALF))
        unfilled = (out.reshape(-1, slots) == _EMPTY).any(axis=1)
        keep = unfilled[owner]
        if not keep.all():
            elements, owner = elements[keep], owner[keep]
            order = order[keep] if order is not None else None
    return out.reshape(-1, slots)


def _bands(signature: np.ndarray, bands: int) -> np.ndarray:
    """One bucket key for each band of each row."""
    n, slots = signature.shape
    width = slots // bands
    key = np.tile(np.arange(bands, dtype=np.uint64) * _GOLD, (n, 1))
    for j in range(width):
        key = mix(key * np.uint64(3) + signature[:, j::width])
    return key.view(np.int64)


def _describe(column: str, width: int, slots: int, bands: int):
    def compute(batch: pa.RecordBatch) -> list[list]:
        values = [t.encode() for t in texts(batch, column)]
        out: list[list] = [[], [], [], [], []]
        for start, end in pieces(values):
            sets = shingle_sets(values[start:end], width)
            signature = signatures(sets, slots)
            keyed = _bands(signature, bands)
            # A byte of each slot, then half of each bucket key.
            sketch = np.hstack([mix(signature).astype(np.uint8), keyed.astype(np.uint32).view(np.uint8)])
            for i, (s, keys) in enumerate(zip(sets, keyed, strict=True)):
                out[0].append(len(s))
                out[1].append(int(mix(s + _GOLD).sum(dtype=np.uint64).view(np.int64)))
                out[2].append(int(np.bitwise_xor.reduce(mix(s ^ _GOLD)).view(np.int64)))
                out[3].append(keys.tolist() if len(s) else [])
                out[4].append(sketch[i].tobytes())
        return out

    return compute


def _confirm(pairs: DataFrame, bodies: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full shingle sets are alike enough."""
    both = pairs.join(bodies.select(F.col("id").alias("b"), F.col("body").alias("text_b")), "b")
    both = both.join(bodies.select(F.col("id").alias("a"), F.col("body").alias("text_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            right = batch.column("text_b").to_pylist()
            left = batch.column("text_a")
            linked, last, base = [], None, None
            step = 64
            for at in range(0, len(a), step):
                there = shingle_sets([t.encode() for t in right[at : at + step]], width)
                for i, theirs in enumerate(there, at):
                    if a[i] != last:
                        last, base = a[i], shingle_sets([left[i].as_py().encode()], width)[0]
                    common = overlap(base, theirs)
                    if 100 * common >= percent * (len(base) + len(theirs) - common):
                        linked.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for i in linked], pa.int64()) for x in (a, b)], names=["a", "b"]
            )

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


class _Block:
    """Members of one or two blocks of a bucket, and the pairs worth comparing."""

    def __init__(self, table: pa.Table, slots: int, percent: int):
        self.ids = table.column("id").to_numpy()
        self.comp = table.column("comp").to_numpy()
        mine = table.column("mine").to_numpy()
        band, self.low, high = (table.column(c)[0].as_py() for c in ("band", "low", "high"))
        rows = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8)
        rows = rows.reshape(len(self.ids), -1)
        self.slot = rows[:, :slots]
        # Halves of the keys of the bands before this bucket's: a common one is handled there.
        self.tag = np.ascontiguousarray(rows[:, slots:]).view(np.uint32)[:, :band]
        self.first, self.second = np.flatnonzero(mine == self.low), np.flatnonzero(mine == high)
        self.alone = self.low == high
        # Four standard deviations below the limit, at most 1/2 for each slot.
        share = percent / 100
        self.limit = slots * share - 4 * (slots * share * (1 - share)) ** 0.5

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """(member, its likely partners in other components)."""
        for i in self.first:
            others = self.second[self.comp[self.second] != self.comp[i]]
            if self.alone:
                others = others[others > i]
            if len(others):
                likely = (self.slot[others] == self.slot[i]).sum(axis=1) >= self.limit
                others = others[likely]
            if len(others):
                others = others[~(self.tag[others] == self.tag[i]).any(axis=1)]
            if len(others):
                yield i, others


def _open_members(live: DataFrame, slots: int, percent: int) -> DataFrame:
    """The members of ``live`` (key, band, id, comp, sketch) that may have links, by block pair."""
    sizes = live.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = live.join(sizes, "key").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "key", "band", "id", "comp", "sketch", "mine",
        F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
    )

    def run(table: pa.Table) -> pa.Table:
        keep = np.zeros(len(table), dtype=bool)
        for i, others in _Block(table, slots, percent).pairs():
            keep[i] = True
            keep[others] = True
        return table.filter(pa.array(keep))

    return dealt.groupBy("key", "low", "high").applyInArrow(run, dealt.schema)


def _links_in_blocks(members: DataFrame, bodies: DataFrame, width: int, slots: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between components, a forest for each block pair."""

    def run(table: pa.Table) -> pa.Table:
        block = _Block(table, slots, percent)
        values = table.column("body").to_pylist()
        sets: dict[int, np.ndarray] = {}
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        def shingles(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_sets([values[i].encode()], width)[0]
            return sets[i]

        found = []
        for i, others in block.pairs():
            mine = shingles(i)
            for o in others.tolist():
                x, y = root(int(block.comp[i])), root(int(block.comp[o]))
                if x == y:
                    continue
                theirs = shingles(o)
                small, large = sorted((len(mine), len(theirs)))
                if 100 * small < percent * large:
                    continue
                common = overlap(mine, theirs)
                if 100 * common >= percent * (small + large - common):
                    parent[x] = y
                    found.append((int(block.ids[i]), int(block.ids[o])))
        return pa.table([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    whole = members.join(bodies, "id")
    return whole.groupBy("key", "low", "high").applyInArrow(run, "a long, b long")


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    slots: int = SLOTS,
    bands: int = BANDS,
) -> DataFrame:
    """(id, ``n_shingles``, ``component_id``, ``kept``), one row for each row of ``df``.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their sets of
    distinct shingles of ``shingle_words`` words (fewer words: one shingle of them all).
    ``component_id`` is the smallest id reachable over links; ``kept`` marks that one.

    NULL, empty and blank texts have the empty set, are linked with nothing and kept. Rows
    sharing an id are one node, linked by whatever any of them is linked by. A row without
    an id takes no part: ``component_id`` is NULL and it is kept. Further columns of ``df``
    are not read, whatever their names; an empty table gives an empty one. ``id_column``
    holds whole numbers and keeps its name.
    """
    spark = df.sparkSession
    stage = Stage(spark)
    source = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("body"))
    made = extend(
        source,
        "n_shingles long, d1 long, d2 long, keys array<long>, sketch binary",
        _describe("body", shingle_words, slots, bands),
        forget,
    )
    facts = stage.write(made.drop("body"))
    nodes = facts.where("id IS NOT NULL AND n_shingles > 0")
    classes = nodes.groupBy("d1", "d2", "n_shingles").agg(F.min("id").alias("rep"))
    member = nodes.select("id", "d1", "d2", "n_shingles").join(classes, ["d1", "d2", "n_shingles"])
    copies = member.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    reps = nodes.join(classes.where("rep IS NOT NULL"), ["d1", "d2", "n_shingles"]).where("id = rep")
    reps = reps.groupBy("id").agg(F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))

    slim = reps.select("id", F.posexplode("keys").alias("band", "key"))
    shared = slim.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    shared = shared.where("low < high")
    placed = stage.write(slim.join(shared, "key"))

    everyone = placed.select("id").distinct()
    needed = source.where("id IS NOT NULL").join(everyone, "id", "left_semi")
    bodies = stage.write(needed.groupBy("id").agg(F.max("body").alias("body")))

    def ends(end: str) -> Column:
        return F.struct(F.least(end, "id").alias("a"), F.greatest(end, "id").alias("b"))

    pairs = placed.select(F.explode(F.array(ends("low"), ends("high"))).alias("p")).select("p.*")
    links = stage.write(_confirm(pairs.where("a < b").distinct(), bodies, shingle_words, percent))
    sketches = stage.write(reps.select("id", "sketch").join(everyone, "id", "left_semi"))
    comp = components(links, stage)
    named = placed.select("key", "band", "id").join(comp, placed["id"] == comp["node"], "left")
    named = named.select("key", "band", "id", F.coalesce("component", "id").alias("comp"))
    several = named.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    live = named.join(several.where("x < y").select("key"), "key").join(sketches, "id")
    members = stage.write(_open_members(live, slots, percent))
    more = stage.write(_links_in_blocks(members, bodies, shingle_words, slots, percent))
    links = links.union(more)
    comp = components(links.union(copies), stage)
    named = facts.select("id", "n_shingles").join(comp, facts["id"] == comp["node"], "left")
    root = F.coalesce("component", "id")
    return named.select(
        F.col("id").alias(id_column),
        "n_shingles",
        root.alias("component_id"),
        F.coalesce(F.col("id") == root, F.lit(True)).alias("kept"),
    )


def keep_one(df: DataFrame, id_column: str = "doc_id", **settings) -> DataFrame:
    """``df`` without the documents that ``near_duplicates`` does not keep.

    Settings are those of ``near_duplicates``. All columns stay as they are; rows sharing
    an id stay or go together, rows without an id stay.
    """
    found = near_duplicates(df, id_column, **settings)
    gone = found.where(~F.col("kept")).select(id_column).distinct()
    return df.join(gone, id_column, "left_anti").select(df.columns)
