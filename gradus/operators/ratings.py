"""From ratings and judge records to one labelled row per question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.functions.labels import judge_label, label_by, note_of
from gradus.functions.text import compose_statement


def rating_summary(
    ratings: DataFrame, strategy: str = "mean", ties_to_even: bool = False
) -> DataFrame:
    """(id, n_ratings, mean_rating, mode_rating, label) per question.

    Counting per (question, rating) first makes everything after it small: a question
    with a third of all ratings is a handful of rows by then. The mode's ties go to
    the rating nearest the mean, then to the smaller one.
    """
    counts = ratings.groupBy(F.col("question_id").alias("id"), F.col("rating")).agg(
        F.count(F.lit(1)).alias("f")
    )
    per_question = Window.partitionBy("id")
    mean = F.sum(F.col("rating") * F.col("f")).over(per_question) / F.sum("f").over(per_question)
    scored = counts.withColumn("mean", mean)
    order = F.struct(-F.col("f"), F.abs(F.col("rating") - F.col("mean")), F.col("rating"))
    summary = scored.groupBy("id").agg(
        F.sum("f").cast("int").alias("n_ratings"),
        F.first("mean").alias("mean"),
        F.min_by("rating", order).cast("int").alias("mode_rating"),
    )
    rounded = F.bround("mean", 3) if ties_to_even else F.round("mean", 3)
    return summary.select(
        "id",
        "n_ratings",
        rounded.alias("mean_rating"),
        "mode_rating",
        label_by(strategy, F.col("mean"), F.col("mode_rating")).alias("label"),
    )


def with_ratings(statements: DataFrame, summary: DataFrame) -> DataFrame:
    """Every statement, with its rating summary where there is one."""
    return statements.join(summary, "id", "left").withColumn(
        "n_ratings", F.coalesce("n_ratings", F.lit(0))
    )


def first_by_id(records: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each id in source order.

    ``row_number() = 1`` makes Spark cut every task's rows to one per id before the
    shuffle, so a much-repeated id is no hot spot.
    """
    rows = Window.partitionBy(key).orderBy(*order)
    return records.withColumn("_rn", F.row_number().over(rows)).where("_rn = 1").drop("_rn")


def judge_columns(raw_label: Column) -> dict[str, Column]:
    """Rating columns of a judge's single verdict: count 1, mean = mode = note."""
    label = judge_label(raw_label)
    note = note_of(label)
    return {
        "n_ratings": F.when(label.isNotNull(), 1).otherwise(0),
        "mean_rating": note.cast("double"),
        "mode_rating": note.cast("int"),
        "label": label,
    }


def judge_questions(records: DataFrame, with_examples: bool = True) -> DataFrame:
    """Judge records to the consolidated question table."""
    kept = first_by_id(records.where(F.col("ID").isNotNull()), "ID", "file", "pos")
    text = compose_statement(
        F.col("Problem_Description"),
        F.col("Input"),
        F.col("Output"),
        F.col("Test_Case") if with_examples else None,
    )
    columns = judge_columns(F.col("metadata.Difficulty"))
    return kept.select(
        F.col("ID").alias("id"),
        text.alias("text"),
        *[c.alias(name) for name, c in columns.items()],
    )


def unmapped_labels(records: DataFrame, raw: str) -> DataFrame:
    """(raw_label, n): labels the scale does not know, most common first."""
    trimmed = F.trim(raw)
    return (
        records.where((trimmed != "") & judge_label(F.col(raw)).isNull())
        .groupBy(trimmed.alias("raw_label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "raw_label")
    )
