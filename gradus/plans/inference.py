"""New questions in, predicted level, concepts and recommendations out."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.operators import models, recommend
from gradus.operators.vectors import TfidfModel, fit_tfidf
from gradus.schema import DUPLICATE_COSINE


def recommend_new(
    new: DataFrame,
    catalog: DataFrame,
    scorer: TfidfModel,
    classifier: PipelineModel,
    n_levels: int = 3,
    k: int = 3,
    ignore_level: bool = False,
    keep_duplicates: bool = False,
) -> DataFrame:
    """(id, source, label, concepts, recommendations), one row per new question.

    ``new``: id, source, words, concepts, flags. ``catalog``: id, source, words, level,
    flags. The level comes from the classifier, also that of catalog rows without one;
    candidates lie within one level of it, or anywhere when that leaves none.
    """
    unknown = models.score_texts(classifier, catalog.where("level IS NULL"), scorer)
    catalog = recommend.with_effective_level(catalog, unknown.select("source", "id", "pred"), n_levels)
    predicted = recommend.with_level(
        models.score_texts(classifier, new, scorer), "pred", n_levels
    ).withColumn("query", F.xxhash64("source", "id"))
    space = fit_tfidf(catalog)
    found = recommend.recommend_for_texts(
        space.transform(predicted),
        space.transform(catalog),
        space,
        k=k,
        window=None if ignore_level else 1,
        max_cosine=None if keep_duplicates else DUPLICATE_COSINE,
        relax=True,
    )
    texts = recommend.recommendation_string(found)
    return predicted.join(texts, "query", "left").select(
        "id",
        "source",
        F.col("pred").alias("label"),
        F.array_join("concepts", ", ").alias("concepts"),
        F.coalesce("recommendations", F.lit("")).alias("recommendations"),
    )
