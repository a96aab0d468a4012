"""Confusion tables and everything that follows from them.

Predictions are counted once per (group, truth, prediction); all metrics are
aggregations of that small table, for every model and fold at the same time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_counts(
    predictions: DataFrame, by: Sequence[str] = (), truth: str = "label", guess: str = "pred"
) -> DataFrame:
    """(by..., truth, pred, n) of the cells that occur."""
    return predictions.groupBy(
        *by, F.col(truth).alias("truth"), F.col(guess).alias("pred")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    counts: DataFrame, scale: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., truth, pred, n) over the true labels present, zeros filled in."""
    cell = F.struct(F.struct("truth", "pred"), F.col("n"))
    tables = counts.groupBy(*by).agg(
        F.collect_set("truth").alias("_present"),
        F.map_from_entries(F.collect_list(cell)).alias("_cells"),
    )
    ordered = F.filter(
        F.array(*map(F.lit, scale)), lambda c: F.array_contains(F.col("_present"), c)
    )
    # A table has at most len(scale) squared cells, so it is unfolded where it stands.
    return (
        tables.select(*by, "_cells", ordered.alias("_present"))
        .select(*by, "_cells", "_present", F.explode("_present").alias("truth"))
        .select(*by, "_cells", "truth", F.explode("_present").alias("pred"))
        .select(
            *by,
            "truth",
            "pred",
            F.coalesce(
                F.element_at("_cells", F.struct("truth", "pred")), F.lit(0).cast("long")
            ).alias("n"),
        )
    )


def confusion_wide(matrix: DataFrame, scale: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per true label, one column per predicted label."""
    return matrix.groupBy(*by, "truth").pivot("pred", list(scale)).agg(F.first("n"))


def _ratio(above: Column, below: Column) -> Column:
    return F.when(below > 0, above / below).otherwise(F.lit(0.0))


def per_class(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., label, precision, recall, f1, support) over true and predicted labels."""
    sides = counts.select(
        *by,
        F.inline(
            F.array(
                F.struct(
                    F.col("truth").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("guessed"),
                    F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("pred").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("guessed"),
                    F.lit(0).cast("long").alias("hit"),
                ),
            )
        ),
    )
    totals = sides.groupBy(*by, "label").agg(
        F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit")
    )
    hit, guessed, support = F.col("hit"), F.col("guessed"), F.col("support")
    return totals.select(
        *by,
        "label",
        _ratio(hit, guessed).alias("precision"),
        _ratio(hit, support).alias("recall"),
        _ratio(2 * hit, guessed + support).alias("f1"),
        "support",
        "hit",
    )


def summary_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., accuracy, f1_macro, f1_weighted, n)."""
    support = F.sum("support")
    return per_class(counts, by).groupBy(*by).agg(
        (F.sum("hit") / support).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / support).alias("f1_weighted"),
        support.alias("n"),
    )


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    measures = ("precision", "recall", "f1")
    total = F.sum("support")

    def line(name: str, values: Sequence[Column]) -> Column:
        named = [v.alias(m) for m, v in zip(measures, values, strict=True)]
        return F.struct(F.lit(name).alias("label"), *named, total.alias("support"))

    accuracy = F.sum("hit") / total
    weighted = [F.sum(F.col(m) * F.col("support")) / total for m in measures]
    own = F.collect_list(F.struct("label", *measures, "support"))
    rows = F.concat(
        own,
        F.array(
            line("accuracy", [accuracy] * 3),
            line("macro avg", [F.avg(m) for m in measures]),
            line("weighted avg", weighted),
        ),
    )
    return per_class(counts, by).groupBy(*by).agg(rows.alias("_rows")).select(
        *by, F.inline("_rows")
    )


def over_folds(fold_metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation over folds."""
    return fold_metrics.groupBy(*by).agg(
        F.avg("accuracy").alias("accuracy"),
        F.stddev_pop("accuracy").alias("accuracy_std"),
        F.avg("f1_macro").alias("f1_macro"),
        F.stddev_pop("f1_macro").alias("f1_macro_std"),
        F.avg("f1_weighted").alias("f1_weighted"),
    )


def coverage(predictions: DataFrame, guess: str = "pred") -> DataFrame:
    """(total, covered, missing) of a prediction column that may have gaps."""
    return predictions.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(guess).alias("covered"),
        F.count_if(F.col(guess).isNull()).alias("missing"),
    )
