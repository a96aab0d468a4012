"""K nearest neighbours by cosine distance, for all settings of a grid at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradus.operators.similarity import Rules, as_queries, prepare, rank_candidates
from gradus.operators.vectors import TfidfModel

NEIGHBOURS = (3, 5, 7, 9)
WEIGHTINGS = ("uniform", "distance")


def neighbours(
    queries: DataFrame, training: DataFrame, model: TfidfModel, k: int = max(NEIGHBOURS)
) -> DataFrame:
    """(query, rank, id, label, distance): the k nearest training rows.

    ``queries``: id, features; ``training``: id, features, label, and ``source`` where ids
    repeat across sources. The labels are joined to the k rows per query afterwards, by
    source and id, so they never travel with the vectors.
    """
    source = F.coalesce("source", F.lit("")) if "source" in training.columns else F.lit("")
    known = training.withColumn("source", source)
    asked = as_queries(prepare(queries.withColumn("query", F.col("id")), ("query",)))
    found = rank_candidates(asked, prepare(known), model.size, Rules(k=k))
    return found.join(known.select("source", "id", "label"), ["source", "id"]).select(
        "query", "rank", "id", "label", (1 - F.col("score")).alias("distance")
    )


def vote(
    near: DataFrame,
    ks: Sequence[int] = NEIGHBOURS,
    weightings: Sequence[str] = WEIGHTINGS,
    by: Sequence[str] = (),
) -> DataFrame:
    """(by..., query, k, weights, pred) for every k and weighting.

    With distance weights a neighbour at distance 0 outvotes everything else. A tie
    goes to the first label in sorted order.
    """
    grid = F.array(
        *[F.struct(F.lit(k).alias("k"), F.lit(w).alias("weights")) for k in ks for w in weightings]
    )
    settings = near.select(*by, "query", "rank", "label", "distance", F.inline(grid)).where(
        F.col("rank") <= F.col("k")
    )
    key = [*by, "query", "k", "weights"]
    exact = F.max((F.col("distance") <= 0).cast("int")).over(Window.partitionBy(*key))
    weight = (
        F.when(F.col("weights") == "uniform", 1.0)
        .when(exact == 1, (F.col("distance") <= 0).cast("double"))
        .otherwise(1 / F.col("distance"))
    )
    votes = settings.withColumn("weight", weight).groupBy(*key, "label").agg(
        F.round(F.sum("weight"), 6).alias("votes")
    )
    order = Window.partitionBy(*key).orderBy(F.desc("votes"), "label")
    return (
        votes.withColumn("_rn", F.row_number().over(order))
        .where("_rn = 1")
        .select(*key, F.col("label").alias("pred"))
    )
