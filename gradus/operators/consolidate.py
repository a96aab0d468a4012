"""Metrics of many sources and granularities side by side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gather(tables: dict[tuple[str, int], DataFrame]) -> DataFrame:
    """Union of the metric tables, tagged with their source and granularity."""
    tagged = [
        df.select(F.lit(source).alias("source"), F.lit(n).alias("n_levels"), "*")
        for (source, n), df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def leaderboard(metrics: DataFrame, by: Sequence[str] = ("source", "n_levels")) -> DataFrame:
    """Adds ``place`` by macro-F1 (ties by model name) within each group."""
    place = Window.partitionBy(*by).orderBy(F.desc("f1_macro"), "model")
    return metrics.withColumn("place", F.row_number().over(place))


def best(metrics: DataFrame, by: Sequence[str] = ("source", "n_levels")) -> DataFrame:
    """The best model of each group."""
    return leaderboard(metrics, by).where("place = 1").drop("place")


def f1_grid(metrics: DataFrame, columns: Sequence[str], pivot: str = "setting") -> DataFrame:
    """Model x setting table of macro-F1; a missing combination is NULL."""
    return metrics.groupBy("model").pivot(pivot, list(columns)).agg(F.first("f1_macro"))
