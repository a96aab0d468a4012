"""Exact quantiles by distributed selection: no group, and no buffer, holds all values.

Values are counted first, so repeated ones are one row each. The counts are dealt by ranges of
(group, value) and written once; how many rows lie before each range is a table of one
number for each range and group. A quantile lies between two neighbouring ranks, and only the
ranges that hold such a rank are looked into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradus.session import durable

QUARTILES = (0.25, 0.5, 0.75)


def value_counts(df: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """(groups..., v, f): how often each value occurs, NULL and NaN left out."""
    rows = df.select(*groups, F.col(column).cast("double").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & ~F.isnan("v"))
    return rows.groupBy(*groups, "v").agg(F.count(F.lit(1)).alias("f"))


def quantiles_of_counts(
    counts: DataFrame, groups: Sequence[str], shares: Sequence[float] = QUARTILES
) -> DataFrame:
    """(groups..., n, q): the rows of each group, and its quantiles in the order of ``shares``.

    ``counts`` has ``groups``, ``v`` and ``f``, one row for each value of a group. Quantiles
    between two ranks are interpolated. A NULL group is a group; without rows there is none.
    """
    groups = list(groups)
    dealt = counts.repartitionByRange(*groups, "v").sortWithinPartitions(*groups, "v")
    dealt = durable(dealt.withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy(*groups, "part").agg(F.sum("f").alias("size"))
    # One row for each range and group: numbers, not data.
    of_group = Window.partitionBy(*groups)
    before = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.select(
        *[F.col(g).alias(f"_{g}") for g in groups],
        F.col("part").alias("_part"),
        "size",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(of_group).alias("n"),
    )
    ranks = [f(F.lit(share) * (F.col("n") - 1)).cast("long") for share in shares for f in (F.floor, F.ceil)]
    wanted = placed.withColumn(
        "ranks",
        F.filter(F.array_distinct(F.array(*ranks)), lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("size"))),
    ).where(F.size("ranks") > 0)
    same = F.col("part") == F.col("_part")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    inside = Window.partitionBy(*groups, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    opened = dealt.join(wanted, same).withColumn("upto", F.col("start") + F.sum("f").over(inside))
    hits = F.filter("ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("f")))
    found = opened.select(*groups, "n", "v", F.explode(hits).alias("rank"))
    # Two ranks for each share at most.
    by_rank = F.map_from_entries(F.collect_list(F.struct("rank", "v")))
    got = found.groupBy(*groups, "n").agg(by_rank.alias("at"))
    values = []
    for share in shares:
        place = F.lit(share) * (F.col("n") - 1)
        low, high = F.element_at("at", F.floor(place).cast("long")), F.element_at("at", F.ceil(place).cast("long"))
        values.append(low + (place - F.floor(place)) * (high - low))
    return got.select(*groups, "n", F.array(*values).alias("q"))


def quantiles(
    df: DataFrame, column: str, shares: Sequence[float] = QUARTILES, groups: Sequence[str] = ()
) -> DataFrame:
    """(groups..., n, q): exact quantiles of ``column`` within each group."""
    return quantiles_of_counts(value_counts(df, groups, column), groups, shares)
