"""Model comparison: the training run and the three-way comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.operators import folds, metrics, models, tagging
from gradus.operators.ranks import sample_rows
from gradus.operators.similarity import prepare
from gradus.operators.vectors import fit_folds, fit_tfidf


def train_and_compare(
    rows: DataFrame,
    families: Sequence[models.Family] = (models.LOGISTIC, models.SVM, models.FOREST),
    n_splits: int = 5,
    with_knn: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(leaderboard, out-of-fold predictions) over the families' whole grids.

    ``rows``: id, text, label. One fold column, one vocabulary per fold from a single
    job, one table of predictions; every metric is computed from that table.
    """
    folded = folds.with_folds(rows, n_splits=n_splits).persist()
    vectors = fit_folds(folded)
    majority = folds.majority_predictions(folded).withColumn("params", F.lit("-"))
    parts = [("majority", majority)]
    if with_knn:
        parts.append(("knn", models.knn_out_of_fold(folded, vectors)))
    for family in families:
        parts.append((family.name, models.out_of_fold(folded, family, models=vectors)))
    columns = ["params", "fold", "id", "label", "pred"]
    predictions = models.label_predictions([(n, df.select(columns)) for n, df in parts])
    best = models.select_best(models.grid_metrics(predictions))
    chosen = predictions.join(F.broadcast(best.select("model", "params")), ["model", "params"])
    overall = metrics.summary_metrics(metrics.confusion_counts(chosen, ["model"]), ["model"])
    honest = overall.select(
        "model", F.col("accuracy").alias("oof_accuracy"), F.col("f1_macro").alias("oof_f1_macro")
    )
    return best.join(honest, "model").orderBy(F.desc("f1_macro"), "model"), predictions


def best_model(rows: DataFrame, family: models.Family, params: dict):
    """Vectoriser and classifier fitted on all labelled rows."""
    vectors = fit_tfidf(rows)
    return vectors, models.fit_classifier(vectors.transform(rows), family, params)


def compare(
    rows: DataFrame,
    n_sample: int | None = None,
    params: dict | None = None,
    tagger_predictions: DataFrame | None = None,
) -> DataFrame:
    """(approach, accuracy, f1_macro, f1_weighted, n): text, text with concepts, tagger.

    ``rows``: id, text, label and, for the second approach, ``flags``. Without
    ``tagger_predictions`` (id, pred) the built-in labeller takes the label of the
    nearest few-shot example. Uncovered rows do not count for the tagger.
    """
    split = folds.train_test_split(rows).persist()
    training, testing = split.where(~F.col("is_test")), split.where("is_test")
    if n_sample:
        testing = sample_rows(testing, n_sample, "id")
    vectors = fit_tfidf(training)
    train_x, test_x = vectors.transform(training), vectors.transform(testing)
    options = params or {"C": 1.0}
    truth = ["id", "label", "pred"]
    text_only = models.fit_classifier(train_x, models.LOGISTIC, options)
    parts = [("A text", text_only.transform(test_x).select(truth))]
    if "flags" in rows.columns:
        both = models.fit_classifier(
            models.with_concept_features(train_x), models.LOGISTIC, options
        )
        parts.append(
            ("C text+concepts", both.transform(models.with_concept_features(test_x)).select(truth))
        )
    if tagger_predictions is None:
        shots = folds.few_shot_sample(training.drop("flags", "concepts"), 1)
        examples = prepare(
            vectors.transform(shots.withColumn("query", F.col("id"))), ("query", "label")
        )
        tagger_predictions = tagging.label_by_example(prepare(test_x), examples, vectors)
    tagged = testing.select("id", "label").join(
        tagger_predictions.select("id", "pred"), "id", "left"
    )
    parts.append(("B tagger", tagged.where("pred IS NOT NULL").select(truth)))
    predictions = models.label_predictions(parts, "approach")
    counts = metrics.confusion_counts(predictions, ["approach"])
    return metrics.summary_metrics(counts, ["approach"]).orderBy(F.desc("f1_macro"), "approach")
