from __future__ import annotations

from dataclasses import asdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gradus.operators import recommend, similarity
from gradus.operators.similarity import Rules, as_queries, near_duplicates, prepare, rank_candidates
from gradus.operators.vectors import fit_tfidf
from gradus.schema import CONCEPTS

WORDS = [f"word{chr(97 + i)}" for i in range(12)]


@pytest.fixture(scope="module")
def corpus(spark):
    """200 short texts; the first 70 are copies of one text."""
    random = np.random.default_rng(7)
    texts = ["worda wordb wordc wordd"] * 70
    texts += [" ".join(random.choice(WORDS, 5)) for _ in range(130)]
    rows = []
    for i, value in enumerate(texts):
        flags = [int(x) for x in random.random(len(CONCEPTS)) < 0.15]
        level = None if i % 9 == 0 else int(random.integers(1, 4))
        rows.append((i, f"s{i % 3}", value, level, flags))
    docs = spark.createDataFrame(
        rows, "id long, source string, text string, level int, flags array<int>"
    ).repartition(5)
    model = fit_tfidf(docs)
    return model, model.transform(docs).persist(), rows


def dense(model, df):
    out = {}
    for r in similarity.sparse_entries(df, "id").collect():
        vector = np.zeros(model.size)
        vector[r.idx] = r.w
        out[r.id] = vector
    return out


def brute(model, catalog, rows, queries, rules, has_concepts):
    """Reference ranking with plain loops."""
    vectors = dense(model, catalog)
    meta = {r[0]: r for r in rows}
    result = {}
    for q, (vector, own, level, flags) in queries.items():
        scored = []
        for i, v in vectors.items():
            _, source, _, item_level, item_flags = meta[i]
            cosine = round(float(v @ vector), 6)
            a, b = np.array(flags), np.array(item_flags)
            union = int(((a + b) > 0).sum())
            jaccard = float((a * b).sum()) / union if union else 0.0
            score = float(v @ vector)
            if has_concepts and a.any():
                score = 0.7 * jaccard + 0.3 * score
            if rules.max_cosine is not None and not cosine < rules.max_cosine:
                continue
            if rules.exclude_self and own == (source, i):
                continue
            inside = True
            if rules.window is not None and level is not None:
                inside = item_level is not None and abs(item_level - level) <= rules.window
            scored.append((inside, -round(score, 6), source, i))
        chosen = [x for x in scored if x[0]]
        if rules.relax and not chosen:
            chosen = scored
        result[q] = [(s, i) for _, _, s, i in sorted(chosen, key=lambda x: x[1:])[: rules.k]]
    return result


def as_lists(df):
    out = {}
    for r in df.orderBy("query", "rank").collect():
        out.setdefault(r.query, []).append((r.source, r.id))
    return out


@pytest.mark.parametrize("window,relax", [(None, False), (1, False), (0, True)])
@pytest.mark.parametrize("max_cosine", [None, 0.95])
def test_rank_candidates_equals_brute_force(corpus, window, relax, max_cosine):
    model, catalog, rows = corpus
    asked = catalog.where("id < 80 and id % 4 = 0").withColumn("query", F.col("id") + 1000)
    rules = Rules(
        k=4, window=window, relax=relax, max_cosine=max_cosine, exclude_self=True, concept_weight=0.7
    )
    vectors = dense(model, catalog)
    queries = {
        r[0] + 1000: (vectors[r[0]], (r[1], r[0]), r[3], r[4])
        for r in rows
        if r[0] < 80 and r[0] % 4 == 0
    }
    expected = {q: v for q, v in brute(model, catalog, rows, queries, rules, True).items() if v}
    prepared = as_queries(prepare(asked, ("query",)))
    whole = as_lists(rank_candidates(prepared, prepare(catalog), model.size, rules))
    assert whole == expected


def test_small_blocks_give_the_same_result(corpus, monkeypatch):
    model, catalog, _ = corpus
    asked = as_queries(prepare(catalog.where("id % 7 = 0").withColumn("query", F.col("id")), ("query",)))
    exclude = catalog.where("id % 5 = 0").select(F.lit(7).cast("long").alias("query"), "source", "id")
    rules = Rules(k=3, window=1, concept_weight=0.7)
    target = prepare(catalog)
    one = as_lists(rank_candidates(asked, target, model.size, rules, exclude))
    several = as_lists(
        rank_candidates(asked, target, model.size, rules, exclude, block_values=10 * (model.size + 15))
    )
    assert one == several
    monkeypatch.setattr(similarity, "WAVE", 1)
    waves = rank_candidates(asked, target, model.size, rules, block_values=15 * (model.size + 15))
    assert as_lists(waves) == as_lists(rank_candidates(asked, target, model.size, rules))
    assert all(i % 5 for _, i in one[7])


def test_near_duplicates_counts_copies(corpus):
    model, catalog, _ = corpus
    asked = as_queries(prepare(catalog.where("id = 3").withColumn("query", F.col("id")), ("query",)))
    for values in (similarity.BLOCK_VALUES, 1):
        row = near_duplicates(asked, prepare(catalog), model.size, 0.95, values).first()
        assert row.n >= 70 and (row.source, row.id) == ("s0", 0)


def test_threshold_is_strict(spark):
    docs = spark.createDataFrame([(1, "s", "aa bb"), (2, "s", "aa bb"), (3, "s", "aa cc"), (4, "s", "cc")],
                                 "id long, source string, text string")
    model = fit_tfidf(docs, ngram_max=1)
    vectors = model.transform(docs)
    asked = as_queries(prepare(vectors.where("id = 1").withColumn("query", F.lit(1)), ("query",)))
    cut = rank_candidates(asked, prepare(vectors), model.size, Rules(k=4, max_cosine=1.0))
    assert {r.id for r in cut.collect()} == {3, 4}


def test_history_centroid_and_unions(corpus, spark):
    model, catalog, rows = corpus
    history = spark.createDataFrame(
        [(1, "s0", 90), (1, "s1", 100), (1, "s1", 100), (2, "s2", 2)],
        "query long, source string, id long",
    )
    vectors = dense(model, catalog)
    got = {r.query: r for r in recommend.centroids(history, catalog).collect()}
    mean = (vectors[90] + vectors[100]) / 2
    mean /= np.linalg.norm(mean)
    built = np.zeros(model.size)
    built[got[1].idx] = got[1].w
    assert np.allclose(built, mean)
    assert got[1].flags == [max(a, b) for a, b in zip(rows[90][4], rows[100][4], strict=True)]


def test_recommend_for_histories(corpus, spark):
    model, catalog, _ = corpus
    history = spark.createDataFrame([(1, "s0", 90), (1, "s1", 100)], "query long, source string, id long")
    users = spark.createDataFrame([(1, 2), (9, None)], "query long, level int")
    got = as_lists(recommend.recommend_for_histories(users, history, catalog, model, k=4))
    assert ("s0", 90) not in got[1] and len(got[1]) == 4
    # Nothing solved, no level: every score is 0, so the first rows by (source, id).
    assert got[9] == [("s0", 0), ("s0", 3), ("s0", 6), ("s0", 9)]


def test_predominant_level(spark):
    catalog = spark.createDataFrame(
        [("s", 1, 1), ("s", 2, 2), ("s", 3, None)], "source string, id long, level int"
    )
    history = spark.createDataFrame(
        [(1, "s", 1), (1, "s", 2), (2, "s", 3)], "query long, source string, id long"
    )
    users = spark.createDataFrame([(1,), (2,), (3,)], "query long")
    got = {r.query: r.level_name for r in recommend.predominant_level(users, history, catalog).collect()}
    assert got == {1: "facil", 2: "facil", 3: None}


def test_recommendation_string_keeps_rank_order(spark):
    ranked = spark.createDataFrame(
        [(1, 2, "a", 5), (1, 1, "b", 6)], "query long, rank int, source string, id long"
    )
    assert recommend.recommendation_string(ranked).first().recommendations == "6(b); 5(a)"


def test_effective_levels_fill_what_has_no_label(spark):
    rows = [("a", 1, 2), ("a", 2, None), ("b", 1, None), (None, 3, None), ("a", 4, None)]
    catalog = spark.createDataFrame(rows, "source string, id long, level int")
    guesses = [("a", 1, "dificil"), ("a", 2, "Fácil"), ("b", 1, "nonsense"), (None, 3, "medio")]
    predictions = spark.createDataFrame(guesses, "source string, id long, pred string")
    got = recommend.with_effective_level(catalog, predictions, 3).collect()
    assert {(r.source, r.id): (r.level, r.effective) for r in got} == {
        ("a", 1): (2, "medio"), ("a", 2): (1, "facil"), ("b", 1): (None, None), (None, 3): (2, "medio"), ("a", 4): (None, None),
    }
    assert recommend.with_effective_level(catalog, predictions.where("false"), 3).where("level IS NULL").count() == 4


def test_cached_concepts_by_source_and_id(spark):
    zeros = [0] * len(CONCEPTS)
    one, two = [1, *zeros[1:]], [0, 1, *zeros[2:]]
    catalog = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), ("a", None), (None, 1)], "source string, id long")
    cache = spark.createDataFrame(
        [("a", "1", one), ("a", "1", two), ("b", "1", two), ("a", "x", one), ("a", None, one)],
        "source string, id string, flags array<int>",
    )
    got = {(r.source, r.id): r.flags for r in recommend.with_cached_concepts(catalog, cache).collect()}
    assert got == {("a", 1): one, ("b", 1): two, ("a", 2): zeros, ("a", None): zeros, (None, 1): zeros}


def test_choosing_queries(spark):
    rows = [(i, f"s{i % 2}", "facil" if i % 3 == 0 else None) for i in range(12)]
    items = spark.createDataFrame(rows, "id long, source string, label string")
    ids = lambda **how: [r.id for r in recommend.choose_queries(items, **how).orderBy("id").collect()]
    assert ids(source="s1", labelled=False, first=3) == [1, 5, 7]
    assert ids(labelled=True) == [0, 3, 6, 9] and len(ids()) == 12
    with pytest.raises(ValueError, match="s9"):
        recommend.choose_queries(items, source="s9")
    assert [r.id for r in recommend.among(items, items.where("id < 2").union(items.where("id < 2"))).orderBy("id").collect()] == [0, 1]


def test_described_rows(spark):
    zeros = [0] * len(CONCEPTS)
    catalog = spark.createDataFrame(
        [("a", 1, "one", "facil", [1, 1, *zeros[2:]]), ("a", 2, None, None, zeros)],
        "source string, id long, text string, effective string, flags array<int>",
    )
    found = spark.createDataFrame([(5, 1, "a", 1, 0.5), (5, 2, "a", 2, 0.4)], "query long, rank int, source string, id long, score double")
    got = [tuple(r) for r in recommend.described(found, catalog).orderBy("rank").collect()]
    both = ", ".join(sorted(CONCEPTS[:2]))
    assert got == [(5, 1, "a", 1, "one", "facil", 0.5, both), (5, 2, "a", 2, None, None, 0.4, "")]


def test_window_reads_only_its_levels(spark, corpus, tmp_path):
    model, catalog, rows = corpus
    path = str(tmp_path / "by_level")
    prepare(catalog).write.partitionBy("level").parquet(path)
    stored = spark.read.parquet(path).select("source", "id", F.col("level").cast("double").alias("level"), "flags", "idx", "w")
    asked = prepare(catalog.where("id = 75 OR id = 80").withColumn("query", F.col("id")).withColumn("level", F.lit(1)), ("query",))
    rules = Rules(k=50, window=0)
    found = rank_candidates(as_queries(asked), stored, model.size, rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    kept = [line for line in plan.split("PartitionFilters: ")[1:]]
    assert kept and all("level" in part.split("PushedFilters")[0] for part in kept)
    level = {i: lev for i, _, _, lev, _ in rows}
    assert {level[r.id] for r in found.collect()} == {1}
    plain = rank_candidates(as_queries(asked), prepare(catalog), model.size, rules)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    unknown = asked.withColumn("level", F.lit(None).cast("double"))
    assert rank_candidates(as_queries(unknown), stored, model.size, Rules(k=500, window=0)).count() > found.count()


class _Shared:
    def __init__(self, block):
        self.value = asdict(block)


def _random_rows(rng, n, size, first=0):
    idx = [np.sort(rng.choice(size, rng.integers(0, 12), replace=False)) for _ in range(n)]
    w = [np.sqrt(rng.dirichlet(np.ones(len(i)))) if len(i) else np.array([]) for i in idx]
    flags = [None if i % 11 == 0 else list(rng.integers(0, 2, 15)) for i in range(n)]
    return pd.DataFrame(
        {
            "query": np.arange(n) * 7 % n + 500, "source": [f"s{i % 3}" for i in range(n)], "id": np.arange(first, first + n),
            "level": [float("nan") if i % 5 == 0 else float(i % 3 + 1) for i in range(n)], "flags": flags, "idx": idx, "w": w,
        }
    )


@pytest.mark.parametrize("rules", [
    Rules(k=3), Rules(k=3, window=1, concept_weight=0.7, exclude_self=True), Rules(k=2, max_cosine=0.3, concept_weight=0.7),
    Rules(k=2, window=0, relax=True, concept_weight=0.7),
])
@pytest.mark.parametrize("screened", [0.0, 1 / 16, 1.0])
def test_screened_rows_equal_all_rows(monkeypatch, rules, screened):
    """After the first batch only rows that may be among the best are scored in full."""
    rng = np.random.default_rng(3)
    block = similarity._block(_random_rows(rng, 37, 60), 64)
    catalog = _random_rows(rng, 2000, 60)
    barred = [[500, 501, 9_999] if i % 4 == 0 else None for i in range(len(catalog))]
    catalog = catalog.assign(excluded_by=barred)
    score = similarity._score_batch
    full = similarity._best(score(catalog, block, rules, 64), rules.k)
    calls = []
    monkeypatch.setattr(similarity, "_score_batch", lambda *a: calls.append(1) or score(*a))
    monkeypatch.setattr(similarity, "CATALOG_VALUES", 64 * 100)
    monkeypatch.setattr(similarity, "SCREENED", screened)
    got = pd.concat(similarity._score_task(_Shared(block), rules, 64)(iter([catalog[:900], catalog[900:]])))
    names = ["query", "source", "id", "in_window", "cosine", "jaccard", "score"]
    keys = ["query", "in_window", "score", "source", "id"]
    a, b = (x.sort_values(keys).reset_index(drop=True)[names] for x in (got, full))
    pd.testing.assert_frame_equal(a, b, check_exact=True)
    if screened == 1.0 and not rules.relax:
        assert len(calls) == 1


def test_exclusions_of_many_blocks_are_computed_once(corpus, spark):
    """Every block read them from their source again; now they are stored once."""
    model, catalog, _ = corpus
    asked = as_queries(prepare(catalog.where("id % 7 = 0").withColumn("query", F.col("id")), ("query",)))
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "long").asNondeterministic()
    exclude = spark.createDataFrame([(7, "s0", i) for i in range(20)], "query long, source string, id long")
    exclude = exclude.withColumn("query", count("query"))
    found = rank_candidates(asked, prepare(catalog), model.size, Rules(k=3), exclude, block_values=5 * (model.size + 15))
    assert found.where("query = 7 and source = 's0' and id < 20").count() == 0
    assert seen.value == 20


def test_blocks_leave_k_rows_for_each_query_whatever_the_tasks(corpus, monkeypatch):
    """What 40 tasks of each block had found was stored, 40 times the rows that are wanted."""
    model, catalog, _ = corpus
    asked = as_queries(prepare(catalog.where("id % 7 = 0").withColumn("query", F.col("id")), ("query",)))
    n, rules = asked.count(), Rules(k=2)
    whole = as_lists(rank_candidates(asked, prepare(catalog), model.size, rules))
    stored, durable = [], similarity.durable
    monkeypatch.setattr(similarity, "durable", lambda df: stored.append(durable(df)) or stored[-1])
    monkeypatch.setattr(similarity, "WAVE", 2)
    wide = prepare(catalog).repartition(40)
    found = rank_candidates(asked, wide, model.size, rules, block_values=5 * (model.size + 15))
    assert as_lists(found) == whole
    waves = [df for df in stored if "score" in df.columns]
    assert len(waves) > 1 and sum(df.count() for df in waves) <= n * rules.k


def test_queries_of_one_level_share_blocks(corpus, monkeypatch):
    """A block of mixed levels reads the whole catalog, with one unknown level rows of no level too."""
    model, catalog, _ = corpus
    asked = as_queries(prepare(catalog.where("id % 3 = 0").withColumn("query", F.col("id")), ("query",)))
    rules, levels, block = Rules(k=3, window=0, concept_weight=0.7), [], similarity._block
    exclude = catalog.where("id % 5 = 0").select((F.col("id") - F.col("id") % 3).alias("query"), "source", "id")
    whole = as_lists(rank_candidates(asked, prepare(catalog), model.size, rules, exclude))
    monkeypatch.setattr(similarity, "_block", lambda rows, size: levels.append(set(rows["level"].fillna(0))) or block(rows, size))
    some = rank_candidates(asked, prepare(catalog), model.size, rules, exclude, block_values=9 * (model.size + 15))
    assert as_lists(some) == whole
    assert len(levels) > 4 and all(len(found) <= 1 for found in levels) and {0, 1, 2, 3} == set().union(*levels)


def test_histories_in_waves_equal_one_wave(corpus, spark, monkeypatch):
    """Profiles of all users lay on disk at once, twice, and their entries were shuffled one by one."""
    model, catalog, rows = corpus
    pairs = [(u, f"s{i % 3}", i) for u in range(40) for i in range(70 + u, 200, 7 + u)] + [(None, "s0", 90), (3, None, 1)]
    history = spark.createDataFrame(pairs + pairs[:50], "query long, source string, id long").repartition(6)
    users = spark.createDataFrame([(u, None if u % 9 == 0 else u % 3 + 1) for u in range(45)], "query long, level int")
    one = as_lists(recommend.recommend_for_histories(users, history, catalog, model, k=3))
    assert len(one) == 45
    monkeypatch.setattr(recommend, "WAVE_VALUES", 10 * (model.size + 15))
    for limit in (0, 10_000):
        monkeypatch.setattr(recommend, "PROFILE_ROWS", limit)
        assert as_lists(recommend.recommend_for_histories(users, history, catalog, model, k=3)) == one
    vectors = dense(model, catalog)
    sums: dict = {}
    for u, _, i in set(pairs):
        if u is not None and i != 1:
            sums[u] = sums.get(u, 0) + vectors[i]
    monkeypatch.setattr(recommend, "OUT_ROWS", 2)
    for got in recommend.centroids(history, catalog).collect():
        built = np.zeros(model.size)
        built[got.idx] = got.w
        assert np.allclose(built, sums[got.query] / np.linalg.norm(sums[got.query]))


def test_tables_of_a_finished_wave_are_deleted(corpus, spark, monkeypatch):
    model, catalog, _ = corpus
    asked = as_queries(prepare(catalog.where("id % 7 = 0").withColumn("query", F.col("id")), ("query",)))
    target, dropped, release = similarity.durable(prepare(catalog)), [], similarity.release
    monkeypatch.setattr(similarity, "release", lambda df: dropped.append(df.columns) or release(df))
    exclude = spark.createDataFrame([(7, "s0", i) for i in range(20)], "query long, source string, id long")
    values = 5 * (model.size + 15)
    found = rank_candidates(asked, target, model.size, Rules(k=3), exclude, values, stored=True)
    assert len(dropped) == 2 and "idx" in dropped[0]
    assert as_lists(found) == as_lists(rank_candidates(asked, target, model.size, Rules(k=3), exclude))
