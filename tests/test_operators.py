from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import folds, knn, metrics, profile, ranks, ratings, vectors
from gradus.schema import LEVELS_3


def rated(spark, notes: dict[int, list[int]]):
    rows = [(q, n) for q, values in notes.items() for n in values]
    return spark.createDataFrame(rows, "question_id long, rating int")


def test_mode_ties_and_labels(spark):
    df = rated(spark, {1: [1, 1, 5, 5, 4], 2: [2, 3], 3: [1] * 21 + [5] * 20, 4: [1] * 15 + [2]})
    mean = {r.id: r for r in ratings.rating_summary(df, "mean").collect()}
    mode = {r.id: r.label for r in ratings.rating_summary(df, "mode").collect()}
    assert mean[1].mode_rating == 5 and mean[2].mode_rating == 2
    assert mean[3].label == "medio" and mode[3] == "muito_facil"
    assert mean[4].mean_rating == 1.063
    even = {r.id: r for r in ratings.rating_summary(df, ties_to_even=True).collect()}
    assert even[4].mean_rating == 1.062


def test_bucketed_ranks_equal_one_big_sort(spark):
    # One label holds most rows, as it may in the data.
    rows = [(i, "a" if i % 10 else "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, label string")
    got = {r.id: (r.rank, r.group_size) for r in ranks.seeded_rank(df, ["label"], ["id"]).collect()}
    for label in "ab":
        ids = sorted((i for i, x in rows if x == label), key=lambda i: (_md5(i), i))
        assert {i: got[i] for i in ids} == {i: (n, len(ids)) for n, i in enumerate(ids, 1)}


def _md5(i: int) -> str:
    import hashlib

    return hashlib.md5(f"42:{i}".encode()).hexdigest()


def test_sequence_rank_with_gaps(spark):
    ids = [0, 1, 2, 5, 10**12, 10**12 + 1]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r.rank for r in ranks.sequence_rank(df, "id").collect()}
    assert got == {i: n for n, i in enumerate(ids, 1)}
    single = spark.createDataFrame([(7,)], "id long")
    assert ranks.sequence_rank(single, "id").first()["rank"] == 1


def labelled(spark, sizes: dict[str, int]):
    rows, number = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((number, label))
            number += 1
    return spark.createDataFrame(rows, "id long, label string")


def test_folds_are_balanced_and_reduced(spark):
    got = folds.with_folds(labelled(spark, {"a": 40, "b": 3}), n_splits=5).collect()
    counts = Counter((r.label, r.fold) for r in got)
    assert {f for _, f in counts} == {0, 1, 2}
    assert all(counts[("b", f)] == 1 for f in range(3))
    assert max(counts[("a", f)] for f in range(3)) - min(counts[("a", f)] for f in range(3)) <= 1


def test_folds_fall_back_to_plain(spark):
    got = folds.with_folds(labelled(spark, {"a": 9, "b": 9, "c": 9, "d": 9, "e": 1}), n_splits=5)
    counts = Counter(r.fold for r in got.collect())
    assert sorted(counts) == [0, 1, 2, 3, 4] and max(counts.values()) - min(counts.values()) <= 1


def test_split_takes_a_fifth_of_each_class(spark):
    got = folds.train_test_split(labelled(spark, {"a": 10, "b": 11})).collect()
    counts = Counter(r.label for r in got if r.is_test)
    assert counts == {"a": 2, "b": 3}


def test_majority_is_taken_outside_the_fold(spark):
    df = spark.createDataFrame(
        [(1, "a", 0), (2, "a", 0), (3, "b", 1), (4, "c", 1)], "id long, label string, fold int"
    )
    assert {r.fold: r.pred for r in folds.majority_by_fold(df).collect()} == {0: "b", 1: "a"}


def test_metrics_against_plain_python(spark):
    pairs = [("facil", "facil")] * 5 + [("facil", "medio")] * 2 + [("medio", "dificil")] * 3
    df = spark.createDataFrame(pairs, "label string, pred string")
    counts = metrics.confusion_counts(df)
    got = metrics.summary_metrics(counts).first()
    f1 = {"facil": 2 * 5 / (5 + 7), "medio": 0.0, "dificil": 0.0}
    assert got.accuracy == pytest.approx(0.5)
    assert got.f1_macro == pytest.approx(sum(f1.values()) / 3)
    assert got.f1_weighted == pytest.approx(0.7 * f1["facil"])
    matrix = metrics.confusion_matrix(counts, LEVELS_3).collect()
    assert {(r.truth, r.pred): r.n for r in matrix} == {
        ("facil", "facil"): 5, ("facil", "medio"): 2, ("medio", "facil"): 0, ("medio", "medio"): 0,
    }
    report = {r.label: r for r in metrics.class_report(counts).collect()}
    assert report["accuracy"].precision == pytest.approx(0.5)
    assert report["weighted avg"].support == 10


def test_histogram_top_edge_and_empty_bins(spark):
    df = spark.createDataFrame([(float(i),) for i in (0, 1, 10)], "v double")
    rows = profile.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r.n for r in rows] == [2, 0, 0, 0, 1]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string")


CORPUS = ["red tree blue", "red tree red", "blue sky tree", "sky", "the of"]


def test_tfidf_against_plain_python(spark):
    docs = texts(spark, CORPUS)
    model = vectors.fit_tfidf(docs, ngram_max=2, min_df=2)
    assert model.n_docs == 4
    df = {"tree": 3, "red": 2, "blue": 2, "sky": 2, "red tree": 2}
    assert set(model.terms) == set(df)
    got = {(r.id, r.term): r.w for r in model.long(model.transform(docs), "id").collect()}
    raw = {t: n * (math.log(5 / (1 + df[t])) + 1) for t, n in {"red": 2, "tree": 1, "red tree": 1}.items()}
    norm = math.sqrt(sum(x * x for x in raw.values()))
    for term, x in raw.items():
        assert got[(1, term)] == pytest.approx(x / norm)
    norms = Counter()
    for (i, _), w in got.items():
        norms[i] += w * w
    assert all(n == pytest.approx(1) for n in norms.values())


def test_vocabulary_limit_breaks_ties_by_term(spark):
    model = vectors.fit_tfidf(texts(spark, ["bb aa", "aa bb", "cc cc cc", "cc"]), max_features=2, ngram_max=1)
    assert model.terms == ["cc", "aa"]


def test_empty_vocabulary(spark):
    docs = texts(spark, ["aa", "bb"])
    model = vectors.fit_tfidf(docs)
    assert model.terms == []
    assert model.long(model.transform(docs), "id").count() == 0


def test_fold_models_equal_direct_fits(spark):
    docs = texts(spark, CORPUS * 4).withColumn("fold", (F.col("id") % 3).cast("int"))
    models = vectors.fit_folds(docs)
    for fold, model in models.items():
        direct = vectors.fit_tfidf(docs.where(F.col("fold") != fold))
        assert (model.terms, model.n_docs) == (direct.terms, direct.n_docs)
        assert np.allclose(model.weights, direct.weights)


def test_vote_zero_distance_and_ties(spark):
    near = spark.createDataFrame(
        [(1, 1, 10, "b", 0.0), (1, 2, 11, "a", 0.1), (1, 3, 12, "a", 0.2),
         (2, 1, 13, "z", 0.5), (2, 2, 14, "y", 0.5), (2, 3, 15, "x", 0.5)],
        "query long, rank int, id long, label string, distance double",
    )
    got = {(r.query, r.weights): r.pred for r in knn.vote(near, ks=[3]).collect()}
    assert got == {
        (1, "uniform"): "a", (1, "distance"): "b", (2, "uniform"): "x", (2, "distance"): "x",
    }


def test_neighbours_of_two_sources_sharing_an_id(spark):
    docs = texts(spark, ["red apple tree", "blue river stone"] * 2)
    model = vectors.fit_tfidf(docs)
    features = model.transform(docs).select("id", "features")
    low = F.col("id") < 2
    known = features.where(low).select(
        F.lit(7).cast("long").alias("id"), "features",
        F.when(F.col("id") == 0, "a").otherwise("b").alias("source"),
        F.when(F.col("id") == 0, "facil").otherwise("dificil").alias("label"),
    )
    near = knn.neighbours(features.where(~low), known, model, k=2).collect()
    assert len(near) == 4
    assert {r.query: r.label for r in near if r.rank == 1} == {2: "facil", 3: "dificil"}
