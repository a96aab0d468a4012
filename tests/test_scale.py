from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame


from gradus.functions import text
from gradus.operators import knn, tagging, vectors
from gradus.operators.similarity import _dense


def test_rows_without_entries_among_queries(spark):
    # Without Arrow, rows come to the driver as lists; an empty one has no type.
    assert _dense([[], [0, 2]], [[], [0.6, 0.8]], 3).tolist() == [[0, 0, 0], [0.6, 0, 0.8]]
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        df = spark.createDataFrame(
            [(1, "sorted lists", "a"), (2, "sorted graphs", "b"), (3, "nothing known", "a"), (4, "lists", "a")],
            "id long, text string, label string",
        )
        model = vectors.fit_tfidf(df, ngram_max=1, min_df=2)
        features = model.transform(df)
        near = knn.neighbours(features.where("id in (3, 4)"), features.where("id in (1, 2)"), model, k=1)
        assert {r.query: r.id for r in near.collect()} == {3: 1, 4: 1}
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")


def _tag_rows(spark):
    rows = [
        ("s", 1, ["a", "b", "a", "x"]), ("s", 2, ["x", "y"]), ("s", 3, []), ("s", 4, None), (None, 5, ["b", None, "y"]),
        ("s", 6, ["c", "y"]), ("s", 6, ["b"]), ("t", None, ["z"]),
    ]
    df = spark.createDataFrame(rows, "source string, id long, words array<string>")
    words = [("a", "A", 9), ("a", "B", 9), ("b", "B", 8), ("y", "C", 2), ("z", "D", 2), ("z", "A", 2), ("y", "C", 2), (None, "D", 9)]
    return df, spark.createDataFrame(words, "word string, concept string, df long")


@pytest.mark.parametrize("limit", [0, 2, 3, 100])
@pytest.mark.parametrize("frequency", [True, False])
def test_concepts_do_not_depend_on_what_is_frequent(spark, limit, frequency):
    df, words = _tag_rows(spark)
    words = words if frequency else words.drop("df")
    got = Counter((r.source, r.id, tuple(r.words or ()), tuple(r.concepts)) for r in tagging.tag_by_dictionary(df, words, ["source", "id"], limit=limit).collect())
    assert got == Counter([
        ("s", 1, ("a", "b", "a", "x"), ("A", "B")), ("s", 2, ("x", "y"), ("C",)), ("s", 3, (), ()), ("s", 4, (), ()),
        (None, 5, ("b", None, "y"), ("B", "C")), ("s", 6, ("c", "y"), ("B", "C")), ("s", 6, ("b",), ("B", "C")),
        ("t", None, ("z",), ("A", "D")),
    ])


def test_only_rows_that_lack_concepts_send_words_to_the_join(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(tagging, "durable", lambda df: stored.append(df.persist()) or stored[-1])
    names = [f"w{i}" for i in range(300)]
    df = spark.createDataFrame([(i, names) for i in range(50)] + [(50, ["w0", "w299"])], "id long, words array<string>")
    words = spark.createDataFrame([(w, f"c{i % 3}", 300 - i) for i, w in enumerate(names)], "word string, concept string, df int")
    got = tagging.tag_by_dictionary(df, words, ["id"], limit=10)
    assert {r.id: len(r.concepts) for r in got.collect()} == {**{i: 3 for i in range(50)}, 50: 2}
    assert [(r._id, r.word) for r in stored[1].collect()] == [(50, "w299")]


def test_dictionary_is_joined_without_copies(spark):
    """Copied rows of a dictionary are broadcast whole, while the planner counts one of each."""
    df, words = _tag_rows(spark)
    plan = tagging.tag_by_dictionary(df, words, ["source", "id"], limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_first_terms_of_a_fold_do_not_meet_in_one_task(spark):
    rows = [(fold, f"t{i:04}", (i * 7) % 90 + 2, 2) for fold in (0, 1) for i in range(900)] + [(0, "", 50, 50), (1, "", 60, 60)]
    counts = spark.createDataFrame(rows, "fold int, term string, total long, df long")
    found = vectors._largest(counts, 101, ("fold",))
    want = {f: [r[1] for r in sorted((r for r in rows if r[0] == f), key=lambda r: (r[1] != "", -r[2], r[1]))[:101]] for f in (0, 1)}
    got = sorted(found.collect(), key=lambda r: (r.fold, r.rn))
    assert {f: [r.term for r in got if r.fold == f] for f in (0, 1)} == want
    # Ranked in buckets first: no window over a whole fold reads the rows themselves.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("row_number") >= 2


def test_first_terms_of_a_corpus_do_not_meet_in_the_driver(spark, monkeypatch):
    plans, collect = [], DataFrame.collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or collect(df))
    docs = spark.createDataFrame([(i, f"common words t{i % 5}") for i in range(40)], "id long, text string")
    model = vectors.fit_tfidf(docs, max_features=3, ngram_max=1)
    assert (model.terms, model.n_docs) == (["common", "words", "t0"], 40)
    # A limit at the root of a plan is merged in the driver.
    assert not plans[0].startswith("GlobalLimit")


def test_words_of_batches_are_the_words_of_columns(spark):
    odd = ["ab", "cd\u00e9 x \ufb01ne of", None, "", "İstanbul ǅ ½ naïve Σ日本 ẞß", "a`b c`d ``` x", "\0 a\0bc\x1ftab", "zz", "b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "id int, text string").coalesce(1)
    for drop in (None, (), ("ab",)):
        both = df.select(text.word_tokens(text.clean_text(F.col("text")), drop).alias("a"), vectors.words_of(F.col("text"), drop).alias("b"))
        assert all(r.a == r.b for r in both.collect())


def test_a_fit_explodes_no_ngrams_and_finds_the_same_terms(spark, monkeypatch):
    rows = [(i, [f"w{(i * i + j * j * 3) % (5 + j % 9)}" for j in range(40)]) for i in range(60)]
    docs = spark.createDataFrame(rows, "id int, words array<string>").repartition(3)
    settings = [(30, 2, 3), (7, 3, 1), (1000, 2, 1), (5, 1, 2)]
    expected = []
    for n, longest, least in settings:
        totals = vectors.term_totals(vectors.with_terms(docs, ngram_max=longest)).where(F.col("df") >= least)
        expected.append([(r.term, vectors.idf(60, r.df)) for r in totals.orderBy(F.desc("total"), "term").limit(n).collect()])

    def refused(*args, **kwargs):
        raise AssertionError("terms counted as strings")

    with monkeypatch.context() as patch:
        patch.setattr(vectors, "term_totals", refused)
        fitted = [vectors.fit_tfidf(docs, n, longest, least) for n, longest, least in settings]
    monkeypatch.setattr(vectors, "NUMBERED", 2)
    fitted += [vectors.fit_tfidf(docs, n, longest, least) for n, longest, least in settings]
    for model, terms in zip(fitted, expected * 2):
        assert list(zip(model.terms, model.weights)) == terms and model.n_docs == 60
    for model in fitted[:4]:
        old = model.transform_terms(docs.withColumn("terms", text.ngrams(F.col("words"), model.ngram_max)))
        new = {r.id: r.features for r in model.transform(docs).collect()}
        assert {r.id: r.features for r in old.collect()} == new


def test_concept_pairs_are_counted_where_they_meet(spark, tmp_path):
    """Every pair of a question and a set was gathered, with both sets, and the words filled the cache."""
    from workload import queries, views

    known = [f"wort{chr(97 + i)}" for i in range(20)]
    docs = [(i, " ".join(known[(i * j + j) % 20] for j in range(i % 7 + 1)), "de", f"s{i % 2}", 9) for i in range(60)]
    asked = [(i, " ".join(known[i : i + 3])) for i in range(12)] + [(3, " ".join(known[3:6])), (50, "nichts davon"), (51, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(asked, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.catalog.clearCache()
    found = queries.concept_jaccard(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "Aggregate [query" in plan and "wanted#" in plan
    assert not any("concepts#" in line.split("Aggregate [")[1].split("]")[0] for line in plan.splitlines() if "Aggregate [query" in line)
    words = views.stored_questions(spark, str(tmp_path))
    dictionary = views.dictionary(words)
    sets = [set(r.concepts) for r in views.tagged(words, dictionary).collect()]
    wanted = {r.query: set(r.concepts) for r in views.tagged(views.new_questions(spark, str(tmp_path)).select("query", "text"), dictionary).collect()}
    expected = Counter((q, round(len(w & s) / len(w | s), 6) if w | s else 0.0) for q, w in wanted.items() for s in sets)
    rows = found.collect()
    got = {(r.query, r.jaccard): r.n for r in rows if r.jaccard > 0 or r.query != 3}
    assert got == {k: n for k, n in expected.items() if k[1] > 0 or k[0] != 3}
