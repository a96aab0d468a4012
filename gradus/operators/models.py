"""Classifiers on TF-IDF features: grids, out-of-fold predictions, scoring.

Fitting uses MLlib's own distributed estimators. Small training sets are put into few
partitions first, since every iteration is a job and its cost is then per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.operators.folds import with_class_weight
from gradus.operators.knn import neighbours, vote
from gradus.operators.metrics import confusion_counts, over_folds, summary_metrics
from gradus.operators.vectors import TfidfModel, fit_folds
from gradus.schema import SEED

ROWS_PER_PARTITION = 4_000
#: Fits of one fold, and classes of one fit, that run side by side: most iterations are short jobs.
CONCURRENT = 4


@dataclass(frozen=True)
class Family:
    """A classifier family and its grid."""

    name: str
    grid: Sequence[dict] = field(default_factory=lambda: [{}])

    def estimator(self, params: dict, total_weight: float):
        columns = {"featuresCol": "features", "labelCol": "target", "weightCol": "weight"}
        # C is the inverse of the penalty on the summed loss; MLlib averages the loss.
        penalty = 1.0 / (params.get("C", 1.0) * total_weight)
        if self.name == "logistic":
            return LogisticRegression(
                regParam=penalty, standardization=False, maxIter=params.get("max_iter", 50), **columns
            )
        if self.name == "svm":
            svm = LinearSVC(
                regParam=penalty, standardization=False, maxIter=params.get("max_iter", 50)
            )
            return OneVsRest(classifier=svm, parallelism=CONCURRENT, **columns)
        if self.name == "forest":
            return RandomForestClassifier(
                numTrees=params.get("trees", 200),
                maxDepth=min(params.get("max_depth", 30), 30),
                seed=SEED,
                **columns,
            )
        raise ValueError(f"unknown classifier family: {self.name!r}")


# The grids that are searched.
LOGISTIC = Family("logistic", [{"C": 0.1}, {"C": 1.0}, {"C": 10.0}])
SVM = Family("svm", [{"C": 0.1}, {"C": 1.0}, {"C": 10.0}])
FOREST = Family(
    "forest",
    [{"trees": t, "max_depth": d} for t in (200, 400) for d in (30,)],
)


def compact(df: DataFrame, n_rows: int) -> DataFrame:
    """Enough partitions for the rows, and no more."""
    wanted = max(1, -(-n_rows // ROWS_PER_PARTITION))
    return df.coalesce(wanted) if wanted < df.rdd.getNumPartitions() else df


def fit_classifier(
    training: DataFrame, family: Family, params: dict, label: str = "label"
) -> PipelineModel:
    """Features to ``pred``, balanced class weights; one self-contained model."""
    return fit_grid(training, family, [params], label)[0]


def fit_grid(
    training: DataFrame, family: Family, grid: Sequence[dict], label: str = "label"
) -> list[PipelineModel]:
    """``fit_classifier`` for every setting of a grid; the rows are prepared once."""
    weighted = with_class_weight(training.select("features", label), label)
    indexer = StringIndexer(
        inputCol=label, outputCol="target", stringOrderType="alphabetAsc"
    ).fit(weighted)
    ready = indexer.transform(weighted).persist()
    few = ready
    try:
        n_rows = ready.count()
        # Kept as it is fitted: an estimator would else keep, and drop, a copy for each setting.
        few = compact(ready, n_rows).persist()

        def fit(params: dict):
            return family.estimator(params, float(n_rows)).fit(few)

        with ThreadPool(max(1, min(CONCURRENT, len(grid)))) as pool:
            fitted = pool.map(inheritable_thread_target(training.sparkSession)(fit), grid, 1)
    finally:
        few.unpersist()
        ready.unpersist()
    return [PipelineModel([classifier, _to_labels(indexer)]) for classifier in fitted]


def _to_labels(indexer: StringIndexerModel) -> IndexToString:
    return IndexToString(inputCol="prediction", outputCol="pred", labels=indexer.labels)


def text_pipeline(vectors: TfidfModel, classifier: PipelineModel) -> PipelineModel:
    """Vectoriser and classifier as one model over a ``terms`` column."""
    return PipelineModel([*vectors.stages.stages, *classifier.stages])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def out_of_fold(
    folded: DataFrame,
    family: Family,
    grid: Sequence[dict] | None = None,
    models: dict[int, TfidfModel] | None = None,
    keep: Sequence[str] = ("id", "label"),
) -> DataFrame:
    """(params, fold, keep..., pred): each row predicted by the fold that left it out.

    ``folded``: id, text, label, fold. Vocabulary and weights come from the training
    part of each fold only.
    """
    per_fold = fit_folds(folded) if models is None else models
    parts = []
    for fold, vectors in sorted(per_fold.items()):
        features = vectors.transform(folded).select("features", "fold", *keep).persist()
        training = features.where(F.col("fold") != fold)
        testing = features.where(F.col("fold") == fold)
        settings = list(grid if grid is not None else family.grid)
        for params, fitted in zip(settings, fit_grid(training, family, settings), strict=True):
            parts.append(
                fitted.transform(testing).select(
                    F.lit(_text(params)).alias("params"), "fold", *keep, "pred"
                )
            )
    return reduce(DataFrame.unionByName, parts)


def knn_out_of_fold(
    folded: DataFrame, models: dict[int, TfidfModel] | None = None
) -> DataFrame:
    """The same for nearest neighbours, all settings from one neighbour list per fold."""
    per_fold = fit_folds(folded) if models is None else models
    lists = []
    for fold, vectors in sorted(per_fold.items()):
        features = vectors.transform(folded).select("id", "label", "fold", "features")
        near = neighbours(
            features.where(F.col("fold") == fold), features.where(F.col("fold") != fold), vectors
        )
        lists.append(near.withColumn("fold", F.lit(fold)))
    votes = vote(reduce(DataFrame.unionByName, lists), by=["fold"])
    truth = folded.select(F.col("id").alias("query"), "label")
    params = F.format_string("k=%d weights=%s", F.col("k"), F.col("weights"))
    return votes.join(truth, "query").select(
        params.alias("params"), "fold", F.col("query").alias("id"), "label", "pred"
    )


def _text(params: dict) -> str:
    return " ".join(f"{k}={v}" for k, v in sorted(params.items())) or "-"


def grid_metrics(predictions: DataFrame, by: Sequence[str] = ("model", "params")) -> DataFrame:
    """Mean and deviation over folds for every setting, from stored predictions."""
    counts = confusion_counts(predictions, by=[*by, "fold"])
    return over_folds(summary_metrics(counts, [*by, "fold"]), by)


def select_best(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """The setting with the best macro-F1 per model; its value is ``selection_score``,
    since it was chosen on the folds that measure it."""
    order = F.struct(-F.col("f1_macro"), F.col("params"))
    columns = [c for c in metrics.columns if c not in by]
    best = metrics.groupBy(*by).agg(F.min_by(F.struct(*columns), order).alias("best"))
    return best.select(*by, "best.*", F.col("best.f1_macro").alias("selection_score"))


def score_texts(model: PipelineModel, df: DataFrame, vectors: TfidfModel) -> DataFrame:
    """Adds ``pred`` to new texts, cleaned the same way."""
    return model.transform(vectors.transform(df)).drop(
        "rawPrediction", "probability", "prediction", "features"
    )


def fill_labels(
    catalog: DataFrame, classifier: PipelineModel | None, vectors: TfidfModel | None, label: str = "label"
) -> DataFrame:
    """Adds ``effective``: the label, else the prediction; NULL when there is no model.

    Only rows without a label are vectorised and scored.
    """
    if classifier is None or vectors is None:
        return catalog.withColumn("effective", F.col(label))
    known = catalog.where(F.col(label).isNotNull()).withColumn("effective", F.col(label))
    scored = score_texts(classifier, catalog.where(F.col(label).isNull()), vectors)
    return known.unionByName(
        scored.withColumnRenamed("pred", "effective").select(*known.columns)
    )


def with_concept_features(df: DataFrame, flags: str = "flags") -> DataFrame:
    """``features`` extended by the 0/1 concept columns; missing concepts are zeros."""
    from gradus.schema import CONCEPTS

    zeros = F.array(*[F.lit(0) for _ in CONCEPTS])
    onehot = array_to_vector(F.coalesce(F.col(flags), zeros).cast("array<double>"))
    assembler = VectorAssembler(inputCols=["_text", "_concepts"], outputCol="features")
    staged = df.withColumnRenamed("features", "_text").withColumn("_concepts", onehot)
    return assembler.transform(staged).drop("_text", "_concepts")


def label_predictions(parts: Iterable[tuple[str, DataFrame]], column: str = "model") -> DataFrame:
    """Union of prediction tables, tagged with their name."""
    tagged = [df.withColumn(column, F.lit(name)) for name, df in parts]
    return reduce(DataFrame.unionByName, tagged)


