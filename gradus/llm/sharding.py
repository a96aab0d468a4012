"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level every child draws a weighted number from the row's key and the child's name,
and the smallest wins: with u uniform in (0, 1), -ln(u) / weight is the weighted form of
highest-random-weight hashing, which picks a child with probability weight / sum. A child's
draw depends on nothing but the key, its own name and its own weight, so a change moves rows
only into or out of the subtrees whose weights changed, and a new subtree takes rows only
into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.staging import Stage, dense_ranks


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree."""

    region: str
    rack: str
    number: int
    weight: float = 1.0


def even_tree(shards: int, per_rack: int = 4, racks: int = 2) -> list[Shard]:
    """Shards 0 .. n-1 of equal weight: ``per_rack`` in a rack, ``racks`` racks in a region."""
    return [
        Shard(f"region{i // (per_rack * racks)}", f"rack{i // per_rack}", i) for i in range(shards)
    ]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, in a rack of a region of its own.

    No other subtree's weight changes, so rows move into the new shard only.
    """
    number = max((s.number for s in tree), default=-1) + 1
    return [*tree, Shard(f"region of {number}", f"rack of {number}", number, weight)]


def _draw(key: Column, level: str, name: str, weight: float) -> Column:
    """-ln(u) / weight: exponential with the child's weight as its rate."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(name)), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / weight


def _pick(key: Column, level: str, children: dict[str, float]) -> Column:
    """The child with the smallest draw; equal draws by name."""
    if len(children) == 1:
        return F.lit(next(iter(children)))
    draws = [
        F.struct(_draw(key, level, name, weight).alias("draw"), F.lit(name).alias("name"))
        for name, weight in sorted(children.items())
    ]
    return F.least(*draws)["name"]


def _weights(tree: list[Shard], name, parent=None) -> dict[str, dict[str, float]]:
    """Children with their summed weights, by parent."""
    found: dict[str, dict[str, float]] = {}
    for shard in tree:
        children = found.setdefault(parent(shard) if parent else "", {})
        children[name(shard)] = children.get(name(shard), 0.0) + shard.weight
    return found


def _descend(key: Column, level: str, parent: Column, below: dict[str, dict[str, float]]) -> Column:
    """For each parent, the pick among its own children only."""
    chosen = F
    for name, children in below.items():
        chosen = chosen.when(parent == name, _pick(key, level, children))
    return chosen.otherwise(F.lit(None))


def place(df: DataFrame, key: Column, tree: list[Shard], column: str) -> DataFrame:
    """``df`` plus ``column``: the shard number of ``key`` in ``tree``.

    Weights must be positive. The tree is part of the plan, so its size is bounded by it:
    thousands of shards, not millions. A NULL key is one key like any other.
    """
    if not tree or any(s.weight <= 0 for s in tree):
        raise ValueError("a tree needs shards, of positive weight")
    if len({s.number for s in tree}) < len(tree):
        raise ValueError("two shards have one number")
    region, rack, leaf = f"_{column}_region", f"_{column}_rack", f"_{column}_leaf"

    def rack_name(s: Shard) -> str:
        return f"{s.region}/{s.rack}"

    regions = _weights(tree, lambda s: s.region)[""]
    racks = _weights(tree, rack_name, lambda s: s.region)
    leaves = _weights(tree, lambda s: str(s.number), rack_name)
    out = df.withColumn(region, _pick(key, "region", regions))
    out = out.withColumn(rack, _descend(key, "rack", F.col(region), racks))
    out = out.withColumn(leaf, _descend(key, "shard", F.col(rack), leaves))
    return out.withColumn(column, F.col(leaf).cast("int")).drop(region, rack, leaf)


def shard(
    df: DataFrame,
    tree: list[Shard],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard), one row for each row of ``df``.

    ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` its unsigned CRC. The law is
    ``key``: the id and the tree decide, so equal rows go together and texts play no part;
    ``grown_shard`` is the place with one more shard. ``slot`` numbers a shard's rows from 0
    by id, without gaps, however large the shard.

    A NULL text has size 1 and CRC 0; a NULL id is placed like any other key and numbered
    first; repeated rows get a slot each, in any order among themselves. Further columns are
    not read, whatever their names. An empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = F.col(id_column)
    rows = df.select(
        key.alias(id_column),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = place(place(rows, key, tree, "shard"), key, grown(tree), "grown_shard")
    ranked = dense_ranks(rows, Stage(df.sparkSession), [id_column, "text_crc32"], group="shard")
    return ranked.select(
        id_column, "size", "text_crc32", "law", "shard", F.col("rank").alias("slot"), "grown_shard"
    )
