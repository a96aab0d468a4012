"""Exact global ranks without sorting a whole group in one task.

``row_number() OVER (PARTITION BY label ORDER BY ...)`` sends a label that holds a
third of the rows to a single task. Here the order key is cut into buckets that
follow the order: ranks inside a bucket are windows of bounded size, and the number
of rows in earlier buckets is added from a small table of bucket counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.schema import SEED


def seeded_key(*keys: str, seed: int = SEED) -> Column:
    """Reproducible pseudo-random order key, the same in any engine with md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def bucketed_rank(
    df: DataFrame, group: list[str], order: list[str], bucket: Column, rank: str = "rank"
) -> DataFrame:
    """Adds ``rank`` (1-based, by ``order`` within ``group``) and ``group_size``.

    ``bucket`` must not decrease along ``order``. The table of bucket counts has at
    most groups x buckets rows; it is joined without a hint, so Spark broadcasts it
    only when its size allows.
    """
    staged = df.withColumn("_bucket", bucket)
    keys = [*group, "_bucket"]
    counts = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(*group)
    # Renamed keys: the counts descend from the same columns as the rows they join.
    offsets = counts.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("group_size"),
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return (
        staged.join(offsets, on)
        .withColumn(rank, F.col("_before") + F.row_number().over(inside))
        .drop("_bucket", "_before", *[f"_key_{k}" for k in keys])
    )


def seeded_rank(
    df: DataFrame,
    group: list[str],
    keys: list[str],
    seed: int = SEED,
    digits: int = 3,
    rank: str = "rank",
) -> DataFrame:
    """Rank within ``group`` in seeded order. ``digits`` hex digits make the buckets:
    3 give 4,096 windows per group."""
    staged = df.withColumn("_order", seeded_key(*keys, seed=seed))
    bucket = F.substring("_order", 1, digits)
    return bucketed_rank(staged, group, ["_order", *keys], bucket, rank).drop("_order")


def sequence_rank(
    df: DataFrame, key: str, group: list[str] | None = None, buckets: int = 4096,
    rank: str = "rank",
) -> DataFrame:
    """Rank by a numeric key; buckets are equal slices of its range."""
    ends = df.agg(
        F.struct(F.min(key).cast("double").alias("lo"), F.max(key).cast("double").alias("hi"))
    ).scalar()
    low, high = ends["lo"], ends["hi"]
    width = F.greatest((high - low) / buckets, F.lit(1e-9))
    bucket = F.floor((F.col(key) - low) / width).cast("int")
    return bucketed_rank(df, group or [], [key], bucket, rank)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows by ``order`` (a top-n, never a global sort)."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int, *keys: str, seed: int = SEED) -> DataFrame:
    """A reproducible random sample of exactly ``n`` rows (or all, if fewer)."""
    return (
        df.withColumn("_order", seeded_key(*keys, seed=seed))
        .orderBy("_order", *keys)
        .limit(n)
        .drop("_order")
    )
