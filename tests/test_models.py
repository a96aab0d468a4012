from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradus.operators import models, vectors
from gradus.operators.vectors import fit_tfidf
from gradus.plans.evaluation import train_and_compare

TOPICS = {"facil": "soma media conta", "medio": "lista vetor matriz", "dificil": "grafo fluxo corte"}


@pytest.fixture(scope="module")
def rows(spark):
    data = []
    for n in range(12):
        for label, words in TOPICS.items():
            parts = words.split()
            data.append((len(data), f"{parts[n % 3]} {parts[(n + 1) % 3]} comum palavra{n % 4}", label))
    return spark.createDataFrame(data, "id long, text string, label string").coalesce(2).persist()


def test_train_and_compare(rows):
    family = models.Family("logistic", [{"C": 1.0, "max_iter": 5}, {"C": 10.0, "max_iter": 5}])
    board, predictions = train_and_compare(rows, [family], n_splits=2)
    predictions = predictions.persist()
    # Every row is predicted once per model and setting.
    counts = predictions.groupBy("model", "params").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("ids")
    )
    assert all(r.n == r.ids == 36 for r in counts.collect())
    scores = {r.model: r for r in board.collect()}
    assert scores["logistic"].f1_macro > 0.9 and scores["knn"].f1_macro > 0.9
    assert scores["majority"].f1_macro < 0.4
    assert scores["logistic"].selection_score == scores["logistic"].f1_macro


def test_saved_pipeline_and_filled_labels(rows, tmp_path):
    model = fit_tfidf(rows)
    fitted = models.fit_classifier(model.transform(rows), models.LOGISTIC, {"C": 10.0, "max_iter": 10})
    path = str(tmp_path / "model")
    models.save_model(models.text_pipeline(model, fitted), path)
    from gradus.operators.vectors import with_terms

    loaded = models.load_model(path).transform(with_terms(rows))
    assert loaded.where("pred = label").count() == 36
    gaps = rows.withColumn("label", F.when(F.col("id") % 2 == 0, F.col("label")))
    filled = {r.id: r.effective for r in models.fill_labels(gaps, fitted, model).collect()}
    assert filled == {r.id: r.label for r in rows.collect()}
    none = models.fill_labels(gaps, None, None)
    assert none.where("effective is null").count() == 18


def test_unknown_family():
    with pytest.raises(ValueError, match="family"):
        models.Family("tree").estimator({}, 1.0)


def test_training_rows_fill_the_cores(spark):
    """Twenty thousand rows in a task left most cores idle in every iteration."""
    rows = spark.range(0, 48_000, 1, 40)
    assert models.compact(rows, 48_000).rdd.getNumPartitions() == 12
    assert models.compact(rows, 900).rdd.getNumPartitions() == 1


def test_fold_counts_shuffle_terms_once(spark):
    rows = [(i % 3, ["aa", "bb", "aa"] if i % 2 else ["bb", f"c{i}"]) for i in range(12)]
    folded = spark.createDataFrame(rows, "fold int, terms array<string>")
    found = vectors.fold_term_counts(folded)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    wanted = {}
    for fold in range(3):
        for own, terms in rows:
            for term in terms if own != fold else ():
                total, _ = wanted.get((fold, term), (0, 0))
                df = sum(term in t for o, t in rows if o != fold)
                wanted[(fold, term)] = (total + 1, df)
    assert {(r.fold, r.term): (r.total, r.df) for r in found.collect()} == wanted
    assert vectors.fold_term_counts(folded.where("false")).count() == 0


def test_svm_query_fits_its_whole_grid(monkeypatch):
    """One setting, ten iterations and three folds left little of the job."""
    from workload import queries

    asked = {}
    monkeypatch.setattr(queries.folds, "with_folds", lambda df, **options: asked.update(options) or df)
    monkeypatch.setattr(queries.views, "training", lambda *args: None)
    monkeypatch.setattr(queries.vectors, "with_words", lambda df: type("Rows", (), {"persist": lambda self: self})())
    monkeypatch.setattr(models, "out_of_fold", lambda rows, family, grid=None: asked.update(family=family, grid=grid))
    queries.svm_oof(None, None)
    assert asked == {"n_splits": 5, "family": models.SVM, "grid": None}
    assert [s["C"] for s in models.SVM.grid] == [0.1, 1.0, 10.0] and not any("max_iter" in s for s in models.SVM.grid)


def test_settings_fitted_side_by_side_equal_single_fits(rows):
    training = fit_tfidf(rows).transform(rows)
    grid = [{"C": 0.01, "max_iter": 3}, {"C": 10.0, "max_iter": 5}]
    fitted = models.fit_grid(training, models.LOGISTIC, grid)
    assert len(fitted) == 2
    for params, model in zip(grid, fitted, strict=True):
        single = models.fit_classifier(training, models.LOGISTIC, params)
        assert model.stages[0].coefficientMatrix == single.stages[0].coefficientMatrix
        assert model.transform(training).select("id", "pred").collect() == single.transform(training).select("id", "pred").collect()
