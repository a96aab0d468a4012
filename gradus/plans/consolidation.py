"""Raw layouts to the consolidated table, and on to the clean corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions.text import clean_words, standard_label
from gradus.operators.ratings import judge_questions, rating_summary, with_ratings
from gradus.sources.files import read_judge, read_ratings, read_statements, require


def from_ratings(
    spark: SparkSession, statements: str, ratings: str, strategy: str = "mean"
) -> DataFrame:
    """Statement files and rating files; unrated statements keep a NULL label."""
    summary = rating_summary(read_ratings(spark, ratings), strategy)
    return with_ratings(read_statements(spark, statements), summary)


def from_judge(spark: SparkSession, path: str, with_examples: bool = True) -> DataFrame:
    """A judge's JSON file, labelled by the judge."""
    return judge_questions(read_judge(spark, path), with_examples)


def clean_corpus(questions: DataFrame, label: str = "label") -> DataFrame:
    """id, text, label and ``clean``; rows without text, or empty once cleaned, drop out."""
    require(questions, ["id", "text", label])
    return (
        questions.where(F.col("text").isNotNull())
        .withColumn("clean", F.explode(F.array(clean_words(F.col("text")))))
        .where(F.col("clean") != "")
        .select("id", "text", standard_label(F.col(label)).alias("label"), "clean")
    )
