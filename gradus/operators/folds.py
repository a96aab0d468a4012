"""Class weights, folds and the train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.operators.ranks import seeded_key, seeded_rank
from gradus.schema import SEED


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, weight) with balanced weights n / (k * n_c)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per class, so the unpartitioned window is small.
    everything = Window.partitionBy()
    total, classes = F.sum("n").over(everything), F.count(F.lit(1)).over(everything)
    return counts.select(label, "n", (total / (classes * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``weight``. The weights have one row per class of a fixed scale."""
    weights = class_weights(df, label).select(F.col(label).alias("_label"), "weight")
    return df.join(weights, F.col(label) == F.col("_label")).drop("_label")


def _class_sizes(df: DataFrame, label: str) -> tuple[Column, Column]:
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    both = sizes.agg(F.struct(F.min("n").alias("smallest"), F.count(F.lit(1)).alias("classes")))
    one = both.scalar()
    return one["smallest"], one["classes"]


def with_folds(
    df: DataFrame, key: str = "id", label: str = "label", n_splits: int = 5, seed: int = SEED
) -> DataFrame:
    """Adds ``fold`` (0..k-1), reproducible and balanced within each class.

    k is the wanted number, at most the size of the smallest class. When a class has
    a single row the folds are plain, not stratified, and k is at most the number of
    classes. Both decisions are scalar subqueries inside the plan.
    """
    smallest, classes = _class_sizes(df, label)
    wanted = F.lit(n_splits)
    stratified = smallest >= 2
    k = F.when(stratified, F.greatest(F.lit(2), F.least(wanted, smallest))).otherwise(
        F.greatest(F.lit(2), F.least(wanted, F.greatest(F.lit(2), classes)))
    )
    grouped = df.withColumn("_stratum", F.when(stratified, F.col(label)).otherwise(F.lit("")))
    ranked = seeded_rank(grouped, ["_stratum"], [key], seed, rank="_rank")
    fold = F.pmod(F.col("_rank") - 1, k).cast("int")
    return ranked.withColumn("fold", fold).drop("_stratum", "_rank", "group_size")


def train_test_split(
    df: DataFrame,
    key: str = "id",
    label: str = "label",
    test_size: float = 0.2,
    seed: int = SEED,
) -> DataFrame:
    """Adds ``is_test`` to the labelled rows; the first ceil(share) of each class.

    Not stratified when a class has a single row.
    """
    labelled = df.where(F.col(label).isNotNull())
    smallest, _ = _class_sizes(labelled, label)
    stratum = F.when(smallest >= 2, F.col(label)).otherwise(F.lit(""))
    ranked = seeded_rank(labelled.withColumn("_stratum", stratum), ["_stratum"], [key], seed, rank="_rank")
    is_test = F.col("_rank") <= F.ceil(F.col("group_size") * F.lit(test_size))
    return ranked.withColumn("is_test", is_test).drop("_stratum", "_rank", "group_size")


def majority_by_fold(folded: DataFrame, label: str = "label") -> DataFrame:
    """(fold, pred): the most frequent label outside each fold, ties alphabetical."""
    counts = folded.groupBy("fold", F.col(label).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    # folds x labels counts, in one row: the rows are read once.
    table = counts.agg(F.collect_list(F.struct("fold", "pred", "n")).alias("cells"))
    pairs = table.select("cells", F.explode(F.array_distinct("cells.fold")).alias("fold")).select(
        "cells", "fold", F.explode(F.array_distinct("cells.pred")).alias("pred")
    )
    elsewhere = F.filter(
        "cells", lambda c: (c["fold"] != F.col("fold")) & (c["pred"] == F.col("pred"))
    )
    outside = F.aggregate(elsewhere, F.lit(0).cast("long"), lambda total, c: total + c["n"])
    order = Window.partitionBy("fold").orderBy(F.desc(outside), "pred")
    return (
        pairs.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").select("fold", "pred")
    )


def majority_predictions(folded: DataFrame, key: str = "id", label: str = "label") -> DataFrame:
    """Out-of-fold predictions of the majority baseline."""
    return folded.join(majority_by_fold(folded, label), "fold").select(
        key, "fold", label, "pred"
    )


def few_shot_sample(
    df: DataFrame, per_class: int = 1, key: str = "id", label: str = "label", seed: int = SEED
) -> DataFrame:
    """``per_class`` reproducible examples of each class, with their ``rank``.

    Ranking with a limit: every task keeps its own first rows per class before the
    shuffle, so the size of a class does not matter.
    """
    order = Window.partitionBy(label).orderBy("_order", key)
    return (
        df.where(F.col(label).isNotNull())
        .withColumn("_order", seeded_key(key, seed=seed))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= per_class)
        .drop("_order")
    )
