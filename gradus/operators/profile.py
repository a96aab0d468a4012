"""Class distributions, size profiles and histograms of a question table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradus.operators.quantiles import quantiles, quantiles_of_counts, value_counts


def class_distribution(df: DataFrame, label: str, scale: Sequence[str]) -> DataFrame:
    """(level, label, n, pct) of the labels that occur, in canonical order."""
    position = F.array_position(F.array(*map(F.lit, scale)), F.col(label)).cast("int")
    counts = (
        df.where(F.col(label).isin(*scale))
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most len(scale) rows by now, so an unpartitioned window is fine.
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(
        position.alias("level"),
        F.col(label).alias("label"),
        "n",
        F.round(F.col("n") * 100.0 / total, 1).alias("pct"),
    ).orderBy("level")


def source_totals(df: DataFrame, source: str = "source", label: str = "label") -> DataFrame:
    """(source, n, labelled, unlabelled)."""
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(label).alias("labelled"),
        (F.count(F.lit(1)) - F.count(label)).alias("unlabelled"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, n_null), all columns in one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in df.columns]
    )
    return row.select(F.inline(pairs))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column.

    The quartiles are exact and come from ``quantiles``, so neither a column of different
    values nor a long one is ever held in one place.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns]
    )
    values = df.select(F.inline(pairs))
    stats = values.groupBy("column_name").agg(
        F.count("v").alias("n"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    parts = quantiles(values, "v", groups=["column_name"]).select("column_name", "q")
    quartiles = [F.col("q")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))]
    return stats.join(parts, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", *quartiles, "max"
    )


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """(bin, low, high, n): equal-width bins, empty ones included, top edge in the last."""
    value = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    low, high = ends["lo"], ends["hi"]
    width = (high - low) / bins
    index = F.when(high > low, F.floor((value - low) / width)).otherwise(F.lit(bins // 2))
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.least(index, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def boxplot(df: DataFrame, group: str, column: str) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR) and outliers per group.

    Works on the counts per (group, value): a group with a third of the rows is as
    small as any other after them.
    """
    counts = value_counts(df.where(F.col(group).isNotNull()), [group], column)
    quartiles = quantiles_of_counts(counts, [group]).withColumnRenamed(group, "_group")
    spans = quartiles.select(
        "_group",
        "q",
        (F.col("q")[0] - 1.5 * (F.col("q")[2] - F.col("q")[0])).alias("floor"),
        (F.col("q")[2] + 1.5 * (F.col("q")[2] - F.col("q")[0])).alias("ceiling"),
    )
    joined = counts.join(spans, F.col(group) == F.col("_group"))
    inside = F.col("v").between(F.col("floor"), F.col("ceiling"))
    return joined.groupBy(group).agg(
        F.sum("f").alias("n"),
        F.first("q")[0].alias("q25"),
        F.first("q")[1].alias("q50"),
        F.first("q")[2].alias("q75"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("f"))).alias("n_outliers"),
    )


def first_example(df: DataFrame, label: str, text: str, order: str) -> DataFrame:
    """The first row of each class, with its whole text.

    The smallest key per class is found first, so no text crosses the shuffle except
    the chosen ones.
    """
    chosen = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("_label")).agg(
        F.min(order).alias("_first")
    )
    on = (F.col(label) == F.col("_label")) & (F.col(order) == F.col("_first"))
    return df.join(chosen, on).select(
        F.col(label).alias("label"), order, F.col(text).alias("example")
    )


def concept_frequency(df: DataFrame, concepts: str = "concepts") -> DataFrame:
    """(concept, n), most frequent first."""
    return (
        df.select(F.explode(concepts).alias("concept"))
        .groupBy("concept")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "concept")
    )
