"""Packs of consecutive items closed by a size budget, without walking a whole table in order.

Next-fit is a chain: where a pack begins depends on where the one before it ended. Items are
dealt by ranges of their key. Within a range only the first ``pack_size`` items can be the
first to begin a pack, so a range is known by a short table: for each of them, how many packs
follow and what the last one holds when the range ends. Those tables are chained, one entry
of each range after the other, and then every range walks its own items from where the
chain says. Only keys and sizes are sorted; texts join the packs at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.session import durable


class _Range:
    """The sizes of a range of items, as they would be packed from any of the first."""

    def __init__(self, sizes: np.ndarray, budget: int, pack_size: int):
        self.sums = np.concatenate([[0], np.cumsum(sizes)])
        self.n, self.budget, self.pack_size = len(sizes), budget, pack_size

    def after(self, start: int, count: int = 0, used: int = 0) -> int:
        """The first item that does not fit a pack holding ``count`` items of size ``used``."""
        room = self.budget - used + self.sums[start]
        end = int(np.searchsorted(self.sums, room, "right")) - 1
        least = start + 1 if not count else start
        return max(least, min(end, start + self.pack_size - count, self.n))

    def walk(self, start: int) -> list[int]:
        """Where packs begin, the first of them at ``start``."""
        begins = []
        while start < self.n:
            begins.append(start)
            start = self.after(start)
        return begins


def _ordered(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    table = table.sort_by("place")
    return table, table.column("size").to_numpy()


def _summaries(dealt: DataFrame, budget: int, pack_size: int) -> DataFrame:
    """For each range its first sizes and, for each first begin, packs and the open pack's state."""

    def run(table: pa.Table) -> pa.Table:
        table, sizes = _ordered(table)
        own = _Range(sizes, budget, pack_size)
        packs, counts, used = [], [], []
        for start in range(min(pack_size, own.n)):
            begins = own.walk(start)
            packs.append(len(begins))
            counts.append(own.n - begins[-1])
            used.append(int(own.sums[-1] - own.sums[begins[-1]]))
        return pa.table(
            {
                "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
                "n": pa.array([own.n], pa.int64()),
                "total": pa.array([int(own.sums[-1])], pa.int64()),
                "heads": pa.array([sizes[:pack_size].tolist()], pa.list_(pa.int64())),
                "packs": pa.array([packs], pa.list_(pa.int64())),
                "counts": pa.array([counts], pa.list_(pa.int64())),
                "used": pa.array([used], pa.list_(pa.int64())),
            }
        )

    longs = ("heads", "packs", "counts", "used")
    schema = "part int, n long, total long, " + ", ".join(f"{c} array<long>" for c in longs)
    return dealt.select("part", "place", "size").groupBy("part").applyInArrow(run, schema)


def _chained(rows: list, budget: int, pack_size: int) -> list[tuple[int, int, int, int]]:
    """(range, its first begin, packs before it, items of the open pack before it)."""
    found, packs, count, used = [], 0, 0, 0
    for row in sorted(rows, key=lambda r: r["part"]):
        heads = _Range(np.array(row["heads"], dtype=np.int64), budget, pack_size)
        entry = heads.after(0, count, used) if count else 0
        found.append((row["part"], entry, packs, count))
        if entry < row["n"]:
            packs += row["packs"][entry]
            count, used = row["counts"][entry], row["used"][entry]
        else:
            count, used = count + row["n"], used + row["total"]
    return found


def assign_packs(df: DataFrame, budget: int, pack_size: int, key: str, size: str) -> DataFrame:
    """(_row, pack, position) of each row of ``df`` (_row, key, size), packs from 0, positions from 1.

    A pack ends before the item that would bring it above ``budget`` or above ``pack_size``
    items; an item larger than the budget is a pack of its own. Order is by ``key``, then
    ``_row``.
    """
    slim = df.select("_row", F.col(key).alias("key"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"))
    dealt = slim.repartitionByRange("key", "_row").sortWithinPartitions("key", "_row")
    # Where the ranges are cut is a sample's choice, so they are stored before they are used.
    dealt = durable(
        dealt.select("_row", "size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    )
    # One row for each range.
    chain = _chained(_summaries(dealt, budget, pack_size).collect(), budget, pack_size)
    spark = df.sparkSession
    begins = spark.createDataFrame(chain, "part int, entry int, packs long, open_items long")

    def run(table: pa.Table) -> pa.Table:
        table, sizes = _ordered(table)
        entry, packs, open_items = (table.column(c)[0].as_py() for c in ("entry", "packs", "open_items"))
        own = _Range(sizes, budget, pack_size)
        begin = np.array(own.walk(entry), dtype=np.int64)
        item = np.arange(own.n)
        number = np.searchsorted(begin, item, "right")
        starts = np.concatenate([[-open_items], begin])
        return pa.table(
            {"_row": table.column("_row"), "pack": pa.array(packs - 1 + number), "position": pa.array(item - starts[number] + 1)}
        )

    return dealt.join(begins, "part").groupBy("part").applyInArrow(run, "_row long, pack long, position long")


def pack_by_size(
    df: DataFrame, budget: int, pack_size: int = 10, key: str = "id", text: str = "text"
) -> DataFrame:
    """(pack, n, first_id, last_id, n_chars, body): consecutive items within a budget of characters.

    Items are numbered from 1 in each pack, as in ``pack_requests``. NULL texts count as
    empty, NULL keys come first, repeated keys are items of their own. So no pack is larger
    than the budget unless it is a single item, and a far-off key is no matter.
    """
    # Stored once, so that the rows keep their numbers; the texts are not sorted.
    rows = durable(
        df.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(key).alias("key"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
            F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("size"),
        )
    )
    placed = assign_packs(rows, budget, pack_size, "key", "size").join(rows, "_row")
    items = F.sort_array(F.collect_list(F.struct("position", "text")))
    body = F.transform(
        items, lambda x: F.concat(F.lit("Item "), x["position"].cast("string"), F.lit(":\n"), x["text"])
    )
    return placed.groupBy("pack").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("key", "position").alias("first_id"),
        F.max_by("key", "position").alias("last_id"),
        F.sum("size").alias("n_chars"),
        F.array_join(body, "\n\n").alias("body"),
    )
