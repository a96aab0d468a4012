"""One query per operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.functions.concepts import concept_columns, concept_set, jaccard, one_hot
from gradus.functions.labels import collapse, parse_label
from gradus.functions.text import (
    clean_text,
    clean_words,
    compose_statement,
    snippet,
    text_size,
)
from gradus.operators import allpairs, consolidate, folds, knn, metrics, models, packing, profile, recommend
from gradus.operators import ranks, ratings, similarity, tagging, vectors
from gradus.plans import evaluation, inference
from gradus.schema import CONCEPTS, LEVELS_3, LEVELS_5
from gradus.session import durable, shared_folder
from gradus.sources.files import parse_json_array
from gradus.sources.split_csv import read_csv_split
from gradus.sources.split_json import read_judge_split
from gradus.sources.tables import catalog_union, contract_report
from gradus.sources.versions import CacheTable
from workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources ------------------------------------------------------------------


@query
def catalog_union_totals(spark, sf_dir):
    docs = views.labelled(spark, sf_dir).select("id", "text", "label")
    benchmark = views.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("id"), "text"
    )
    turns = views.table(spark, sf_dir, "conversations").where("role = 'user'").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
    )
    union = catalog_union({"documents": docs, "benchmark": benchmark, "conversations": turns})
    return union.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("label").alias("labelled"),
        F.sum("id").alias("id_sum"),
        F.sum(F.length("text")).alias("chars"),
    )


@query
def input_contract(spark, sf_dir):
    rows = views.labelled(spark, sf_dir)
    # Two sources share their ids, so the check on the id alone finds duplicates.
    both = rows.select("id", "text", "label").unionByName(
        views.table(spark, sf_dir, "benchmark").select(
            F.col("item_id").alias("id"), F.nullif("text", F.lit("")).alias("text"),
            F.lit("unrated").alias("label"),
        )
    )
    return contract_report(both, ["id"], "text", "label", LEVELS_5)


@query
def json_array_repair(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    body = F.concat(F.lit("["), F.col("props"), F.lit(', {"k": -1}'))
    raw = (
        F.when(kind == 0, F.concat(body, F.lit("]")))
        .when(kind == 1, F.concat(body, F.lit(",\n")))
        .when(kind == 2, body)
        .otherwise(F.concat(body, F.lit("]  \n")))
    )
    element = T.StructType([T.StructField("k", T.LongType())])
    parsed = events.select("event_id", parse_json_array(raw, element).alias("items"))
    return parsed.select(
        "event_id",
        F.size("items").alias("n_items"),
        F.col("items")[0]["k"].alias("first_k"),
        F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["k"]).alias("sum_k"),
    )


@query
def csv_records(spark, sf_dir):
    """The documents written as CSV, newlines and quotes in their texts, and read back in splits."""
    docs = views.questions(spark, sf_dir).select("id", "source", "text")
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.write.csv(path, header=True, escape='"', quoteAll=True, nullValue="", emptyValue='""', **kept)
    back = read_csv_split(spark, path, docs.schema)
    return back.select("id", "source", F.md5("text").alias("text_md5"))


@query
def json_array_records(spark, sf_dir):
    """The documents as JSON arrays whose files lost their closing bracket, read in splits."""
    docs = views.questions(spark, sf_dir)
    record = F.struct(F.col("id").alias("ID"), F.col("text").alias("Problem_Description"), F.struct(F.col("lang").alias("Difficulty")).alias("metadata"))
    # A file for each partition; the low bits of the id are the place in it, as documented.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    array = docs.select(F.concat(F.when(first, "[").otherwise(""), F.to_json(record), F.lit(",")).alias("value"))
    path = f"{shared_folder(spark)}/json-{uuid.uuid4().hex}"
    array.write.option("lineSep", "\n").format("text").save(path)
    back = read_judge_split(spark, path, pattern="*.txt")
    return back.select(
        F.col("ID").alias("id"),
        F.md5("Problem_Description").alias("text_md5"), F.col("metadata.Difficulty").alias("lang"),
    )


# --- text ---------------------------------------------------------------------


@query
def clean_text_plain(spark, sf_dir):
    docs = views.wide_questions(spark, sf_dir)
    return docs.select("id", clean_text(F.col("text")).alias("clean"))


@query
def clean_text_stopwords(spark, sf_dir):
    docs = views.wide_questions(spark, sf_dir)
    return docs.select("id", clean_words(F.col("text")).alias("clean"))


@query
def compose_statements(spark, sf_dir):
    docs = views.wide_questions(spark, sf_dir)
    lines = F.split("text", "\n")
    cases = F.transform(
        lines,
        lambda line, i: F.struct(
            F.when(i % 3 == 1, "  ").otherwise(line).alias("input"),
            F.when(i % 3 != 0, F.lit(None).cast("string")).otherwise(line).alias("output"),
        ),
    )
    text = compose_statement(
        lines[0], F.when(F.col("id") % 2 == 0, F.col("lang")), F.col("source"), cases
    )
    return docs.select("id", text.alias("statement"))


@query
def label_freeform(spark, sf_dir):
    spelled = F.concat_ws(
        "",
        F.element_at(
            F.array(*map(F.lit, ["", "Muito ", "very_", "seria  ", "nível-", "VERY "])),
            (F.col("l_orderkey") % 6 + 1).cast("int"),
        ),
        F.element_at(
            F.array(*map(F.lit, ["Fácil", "easy", "MÉDIO", "Medium", "difícil", "hard", "alta", "simples", "xyz abc"])),
            (F.col("l_partkey") % 9 + 1).cast("int"),
        ),
    )
    lines = views.table(spark, sf_dir, "lineitem")
    # The spellings are few; counting them first leaves the parser a handful of rows.
    counted = lines.groupBy(spelled.alias("answer")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("answer", parse_label(F.col("answer")).alias("label"), "n")


@query
def text_snippet(spark, sf_dir):
    return views.questions(spark, sf_dir).select("id", snippet(F.col("text"), 90).alias("snippet"))


@query
def text_sizes(spark, sf_dir):
    chars, words = text_size(F.col("text"))
    return views.questions(spark, sf_dir).select(
        "id", chars.alias("n_characters"), words.alias("n_words")
    )


# --- labels -------------------------------------------------------------------


@query
def rating_label_mean(spark, sf_dir):
    return ratings.rating_summary(views.ratings(spark, sf_dir), "mean")


@query
def rating_label_mode(spark, sf_dir):
    return ratings.rating_summary(views.ratings(spark, sf_dir), "mode")


@query
def statements_with_ratings(spark, sf_dir):
    parts = views.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("text")
    )
    rated = views.ratings(spark, sf_dir).where(F.col("question_id") % 3 != 0)
    return ratings.with_ratings(parts, ratings.rating_summary(rated, "mean"))


@query
def judge_labels(spark, sf_dir):
    columns = ratings.judge_columns(F.col("raw_label"))
    return views.judged(spark, sf_dir).select("id", *[c.alias(n) for n, c in columns.items()])


@query
def unmapped_labels(spark, sf_dir):
    return ratings.unmapped_labels(views.judged(spark, sf_dir), "raw_label")


@query
def first_record_by_id(spark, sf_dir):
    records = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("id"), "l_orderkey", "l_linenumber", "l_quantity"
    )
    kept = ratings.first_by_id(
        records.where("id IS NOT NULL"), "id", "l_orderkey", "l_linenumber", "l_quantity"
    )
    return kept.select("id", "l_orderkey", "l_quantity")


@query
def collapse_levels(spark, sf_dir):
    label = F.when(F.col("id") % 10 == 0, "outro").otherwise(F.col("label"))
    rows = views.labelled(spark, sf_dir).select("id", label.alias("label"))
    return rows.select(
        "id",
        "label",
        collapse(F.col("label")).alias("for_training"),
        collapse(F.col("label"), keep_unknown=True).alias("for_catalog"),
    )


# --- profile ------------------------------------------------------------------


@query
def class_distribution(spark, sf_dir):
    return profile.class_distribution(views.labelled(spark, sf_dir), "label", LEVELS_5)


@query
def source_totals(spark, sf_dir):
    return profile.source_totals(views.labelled(spark, sf_dir))


@query
def null_profile(spark, sf_dir):
    parts = views.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("text")
    )
    rated = views.ratings(spark, sf_dir).where(F.col("question_id") % 3 != 0)
    return profile.null_profile(ratings.with_ratings(parts, ratings.rating_summary(rated, "mean")))


def _sized(spark, sf_dir) -> DataFrame:
    chars, words = text_size(F.col("text"))
    return views.labelled(spark, sf_dir).select(
        "id", "label", "text", chars.alias("n_characters"), words.alias("n_words")
    )


@query
def numeric_profile(spark, sf_dir):
    stats = profile.numeric_profile(_sized(spark, sf_dir), ["n_characters", "n_words"])
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    return stats.select("column_name", "n", *rounded)


@query
def histogram_40(spark, sf_dir):
    bins = profile.histogram(_sized(spark, sf_dir), "n_characters", 40)
    return bins.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


@query
def boxplot_by_level(spark, sf_dir):
    return profile.boxplot(_sized(spark, sf_dir), "label", "n_words")


@query
def first_example(spark, sf_dir):
    return profile.first_example(views.labelled(spark, sf_dir), "label", "text", "id")


# --- vectors ------------------------------------------------------------------


@query
def vocabulary(spark, sf_dir):
    return vectors.vocabulary(vectors.with_terms(views.wide_questions(spark, sf_dir)))


def _rounded_long(model, df, key="id"):
    long = model.long(model.transform(df), key)
    return long.select(key, "term", F.round("w", 6).alias("w"))


@query
def tfidf_unigrams(spark, sf_dir):
    docs = views.cleaned_questions(spark, sf_dir)
    return _rounded_long(vectors.fit_tfidf(docs, ngram_max=1), docs)


@query
def tfidf_bigrams(spark, sf_dir):
    docs = views.cleaned_questions(spark, sf_dir)
    return _rounded_long(vectors.fit_tfidf(docs), docs)


@query
def tfidf_transform(spark, sf_dir):
    model = vectors.fit_tfidf(views.wide_questions(spark, sf_dir))
    items = views.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return _rounded_long(model, items)


def _folded(spark, sf_dir, n_levels=3) -> DataFrame:
    return folds.with_folds(views.training(spark, sf_dir, n_levels))


@query
def fold_document_frequency(spark, sf_dir):
    words = vectors.with_words(_folded(spark, sf_dir)).persist()
    return vectors.fold_term_counts(vectors.with_terms(words, ngram_max=1))


# --- similarity ---------------------------------------------------------------


def _ranked(found: DataFrame, *columns: str) -> DataFrame:
    return found.select("query", F.col("rank").cast("int").alias("rank"), *columns)


@query
def similar_topk(spark, sf_dir):
    docs = views.cleaned_questions(spark, sf_dir)
    model = vectors.fit_tfidf(docs)
    asked = model.transform(views.new_questions(spark, sf_dir).withColumn("id", F.col("query")))
    found = similarity.similar_topk(
        similarity.as_queries(similarity.prepare(asked.drop("level"), ("query",))),
        similarity.prepare(model.transform(docs)),
        model.size,
        k=5,
    )
    return _ranked(found, "source", "id", "score")


@query
def near_duplicates(spark, sf_dir):
    docs = views.cleaned_questions(spark, sf_dir)
    model = vectors.fit_tfidf(docs)
    new = views.new_questions(spark, sf_dir)
    asked = model.transform(new.withColumn("id", F.col("query")).drop("level"))
    return similarity.near_duplicates(
        similarity.as_queries(similarity.prepare(asked, ("query",))),
        similarity.prepare(model.transform(docs)),
        model.size,
        threshold=0.3,
    )


def _all_vectors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The cleaned documents and their vectors."""
    docs = views.cleaned_questions(spark, sf_dir)
    return docs, similarity.prepare(vectors.fit_tfidf(docs).transform(docs))


@query
def near_duplicate_classes(spark, sf_dir):
    """Every document with the first one of the same vector."""
    return allpairs.class_names(_all_vectors(spark, sf_dir)[1])


@query
def near_duplicate_pairs(spark, sf_dir):
    """All pairs of different vectors with a cosine of 0.95 or more."""
    docs, found = _all_vectors(spark, sf_dir)
    members = allpairs.vector_classes(found)
    docs.unpersist()  # the vectors are stored
    return allpairs.alike_pairs(members)


@query
def concept_jaccard(spark, sf_dir):
    docs = views.stored_questions(spark, sf_dir)
    words = views.dictionary(docs)
    # Distinct concept sets are few (at most 2 to the size of the taxonomy), so their
    # overlap is computed per set and items are only counted.
    sets = durable(views.tagged(docs, words).groupBy("concepts").agg(F.count(F.lit(1)).alias("n")))
    asked = views.tagged(
        views.new_questions(spark, sf_dir).select("query", "text"), words
    ).select("query", F.col("concepts").alias("wanted"))
    overlap = F.round(jaccard(F.col("wanted"), F.col("concepts")), 6)
    # A pair meets at each concept it shares and counts at the first: pairs need not be gathered.
    shared = sets.select("concepts", "n", F.explode("concepts").alias("c")).join(
        asked.distinct().select("query", "wanted", F.explode("wanted").alias("c")), "c"
    )
    once = shared.where(F.col("c") == F.array_min(F.array_intersect("wanted", "concepts")))
    bins = once.groupBy("query", overlap.alias("jaccard")).agg(F.sum("n").alias("n"))
    # Sets without a common concept make no pair: they are all items less the others.
    others = bins.groupBy("query").agg(F.sum("n").alias("met"))
    left = sets.agg(F.sum("n")).scalar() - F.coalesce("met", F.lit(0))
    apart = asked.select("query").join(others, "query", "left")
    apart = apart.select("query", F.lit(0.0).alias("jaccard"), left.alias("n"))
    return bins.unionByName(apart.where("n > 0"))


@query
def blended_topk(spark, sf_dir):
    docs = views.cleaned_questions(spark, sf_dir)
    model = vectors.fit_tfidf(docs)
    words = views.dictionary(docs)
    catalog = views.tagged(model.transform(docs), words)
    asked = views.tagged(model.transform(views.new_questions(spark, sf_dir).drop("level")), words)
    found = recommend.recommend_for_texts(
        asked, catalog, model, k=5, window=None, max_cosine=None, exclude_self=False
    )
    return _ranked(found, "source", "id", "score", "cosine", "jaccard")


@query
def knn_label(spark, sf_dir):
    split = folds.train_test_split(views.training(spark, sf_dir))
    rows = vectors.with_words(split).persist()
    training = rows.where(~F.col("is_test"))
    model = vectors.fit_tfidf(training)
    features = model.transform(rows)
    near = knn.neighbours(
        features.where("is_test"), features.where(~F.col("is_test")), model
    )
    return knn.vote(near)


# --- folds and metrics --------------------------------------------------------


@query
def class_weights(spark, sf_dir):
    weights = folds.class_weights(views.training(spark, sf_dir, 5))
    return weights.select("label", "n", F.round("weight", 6).alias("weight"))


@query
def stratified_folds(spark, sf_dir):
    return _folded(spark, sf_dir, 5).select("id", "label", "fold")


@query
def train_test_split(spark, sf_dir):
    return folds.train_test_split(views.training(spark, sf_dir, 5)).select("id", "label", "is_test")


@query
def seeded_sample(spark, sf_dir):
    return ranks.sample_rows(views.questions(spark, sf_dir).select("id", "source"), 40, "id")


@query
def majority_by_fold(spark, sf_dir):
    return folds.majority_by_fold(_folded(spark, sf_dir, 5))


def _predictions(spark, sf_dir) -> DataFrame:
    """Two simple predictors, so that metrics have something to compare:
    the majority of the other folds, and the level suggested by the language."""
    folded = folds.with_folds(
        views.supervised(spark, sf_dir)
        .select("id", "lang", collapse(F.col("label")).alias("label"))
    ).persist()
    majority = folded.join(folds.majority_by_fold(folded), "fold").withColumn(
        "model", F.lit("majority")
    )
    guess = F.when(F.col("lang") == "en", "facil").when(F.col("lang") == "de", "medio")
    language = folded.withColumn("pred", guess.otherwise("dificil")).withColumn(
        "model", F.lit("language")
    )
    columns = ["model", "fold", "id", "label", "pred"]
    return majority.select(columns).unionByName(language.select(columns))


@query
def confusion_matrix(spark, sf_dir):
    counts = metrics.confusion_counts(_predictions(spark, sf_dir), by=["model"])
    return metrics.confusion_matrix(counts, LEVELS_3, by=["model"])


@query
def confusion_wide(spark, sf_dir):
    counts = metrics.confusion_counts(_predictions(spark, sf_dir), by=["model"])
    matrix = metrics.confusion_matrix(counts, LEVELS_3, by=["model"])
    return metrics.confusion_wide(matrix, LEVELS_3, by=["model"])


@query
def class_report(spark, sf_dir):
    counts = metrics.confusion_counts(_predictions(spark, sf_dir), by=["model"])
    report = metrics.class_report(counts, by=["model"])
    return report.select(
        "model", "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def _fold_metrics(spark, sf_dir) -> DataFrame:
    counts = metrics.confusion_counts(_predictions(spark, sf_dir), by=["model", "fold"])
    return metrics.over_folds(metrics.summary_metrics(counts, ["model", "fold"]), ["model"])


@query
def fold_mean_std(spark, sf_dir):
    table = _fold_metrics(spark, sf_dir)
    return table.select("model", *[F.round(c, 6).alias(c) for c in table.columns if c != "model"])


def _source_metrics(spark, sf_dir) -> DataFrame:
    """Metrics of both predictors for every document source, 3 and 5 levels."""
    rows = views.supervised(spark, sf_dir)
    guess5 = F.when(F.col("lang") == "en", "facil").when(F.col("lang") == "de", "medio")
    guess5 = guess5.otherwise("muito_dificil")
    parts = {}
    for name, pred in {"language": guess5, "always_medio": F.lit("medio")}.items():
        five = rows.select("source", "label", pred.alias("pred"))
        three = five.select("source", collapse(F.col("label")).alias("label"), collapse(F.col("pred")).alias("pred"))
        for n, table in ((5, five), (3, three)):
            parts[(name, n)] = table.select(
                "source", F.lit(n).alias("n_levels"), F.lit(name).alias("model"), "label", "pred"
            )
    whole = None
    for part in parts.values():
        whole = part if whole is None else whole.unionByName(part)
    by = ["source", "n_levels", "model"]
    table = metrics.summary_metrics(metrics.confusion_counts(whole, by=by), by)
    return table.select(*by, *[F.round(c, 6).alias(c) for c in ("accuracy", "f1_macro", "f1_weighted")])


@query
def leaderboard(spark, sf_dir):
    board = consolidate.leaderboard(_source_metrics(spark, sf_dir))
    return board.withColumn("place", F.col("place").cast("int"))


@query
def best_by_source(spark, sf_dir):
    return consolidate.best(_source_metrics(spark, sf_dir))


@query
def f1_grid(spark, sf_dir):
    rows = _source_metrics(spark, sf_dir)
    setting = F.concat_ws("_", "source", F.col("n_levels").cast("string"))
    return consolidate.f1_grid(rows.withColumn("setting", setting), views.SETTINGS)


# --- recommendation -----------------------------------------------------------


def _recommender(spark, sf_dir):
    """(model, dictionary, catalog with features, level and flags)."""
    docs = views.catalog(spark, sf_dir)
    # Counted once for the vocabulary and the dictionary.
    totals = durable(vectors.word_totals(docs))
    model = vectors.fit_tfidf(docs, totals=totals)
    words = views.dictionary(docs, totals)
    # Used for the profiles and again for the candidates; the words are not needed any more.
    catalog = durable(views.tagged(model.transform(docs), words).drop("words"))
    docs.unpersist()
    return model, words, catalog


@query
def recommend_text(spark, sf_dir):
    model, words, catalog = _recommender(spark, sf_dir)
    asked = views.tagged(model.transform(views.new_questions(spark, sf_dir)), words)
    found = recommend.recommend_for_texts(asked, catalog, model, k=5, exclude_self=False)
    return _ranked(found, "source", "id", "score")


@query
def recommend_relaxed(spark, sf_dir):
    model, words, catalog = _recommender(spark, sf_dir)
    # Nothing in this catalog is on the top level, so its queries must be relaxed.
    lower = catalog.withColumn("level", F.nullif("level", F.lit(3)))
    asked = views.tagged(model.transform(views.new_questions(spark, sf_dir)), words)
    found = recommend.recommend_for_texts(
        asked, lower, model, k=3, window=0, relax=True, exclude_self=False
    )
    return _ranked(found, "source", "id", "score", "in_window")


@query
def recommend_history(spark, sf_dir):
    model, _, catalog = _recommender(spark, sf_dir)
    found = recommend.recommend_for_histories(
        views.users(spark, sf_dir), views.history(spark, sf_dir), catalog, model, k=5, stored=True
    )
    return _ranked(found, "source", "id", "score")


@query
def user_level(spark, sf_dir):
    catalog = views.catalog_levels(spark, sf_dir)
    return recommend.predominant_level(
        views.users(spark, sf_dir), views.history(spark, sf_dir), catalog
    )


@query
def recommend_user_level(spark, sf_dir):
    model, _, catalog = _recommender(spark, sf_dir)
    found = recommend.recommend_next_level(
        views.users(spark, sf_dir), views.history(spark, sf_dir), catalog, model, k=5, stored=True
    )
    return _ranked(found, "source", "id", "score")


@query
def recommend_reasons(spark, sf_dir):
    model, words, catalog = _recommender(spark, sf_dir)
    asked = views.tagged(model.transform(views.new_questions(spark, sf_dir)), words)
    found = recommend.recommend_for_texts(asked, catalog, model, k=3, exclude_self=False)
    return recommend.reasons(_ranked(found, "source", "id", "score"), asked, catalog)


@query
def recommend_string(spark, sf_dir):
    return recommend.recommendation_string(recommend_text(spark, sf_dir))


@query
def recommend_effective(spark, sf_dir):
    """Recommendations as they are shown; rows without a label have the level of their language."""
    model, words, catalog = _recommender(spark, sf_dir)
    docs = views.questions(spark, sf_dir)
    guess = F.when(F.col("lang") == "en", "facil").when(F.col("lang") == "de", "medio").otherwise("dificil")
    filled = recommend.with_effective_level(catalog, docs.select("source", "id", guess.alias("pred")), 3)
    asked = views.tagged(model.transform(views.new_questions(spark, sf_dir)), words)
    # Computed once; levels and texts are looked up for the recommended rows only.
    found = durable(recommend.recommend_for_texts(asked, filled, model, k=5, exclude_self=False))
    texts = recommend.among(docs.select("source", "id", "text"), found)
    shown = recommend.described(found, recommend.among(filled, found).join(texts, ["source", "id"]))
    return _ranked(shown, "source", "id", F.md5("text").alias("text_md5"), "effective", "score", "concepts")


@query
def chosen_queries(spark, sf_dir):
    """The first 25 items of one source that have no label."""
    chosen = recommend.choose_queries(views.labelled(spark, sf_dir), "src3", labelled=False, first=25)
    return chosen.select("id", "source", F.md5("text").alias("text_md5"))


@query
def catalog_concepts(spark, sf_dir):
    """Concepts of two sources by (source, id); cached are the documents that have labels."""
    docs = views.cleaned_questions(spark, sf_dir)
    marked = recommend.among(docs, views.supervised(spark, sf_dir))
    cache = views.tagged(marked, views.dictionary(docs)).select("source", F.col("id").cast("string").alias("id"), "flags")
    items, _ = _two_sources(spark, sf_dir)
    found = recommend.with_cached_concepts(items, cache)
    return found.select("source", "id", F.array_join(concept_set(F.col("flags")), ",").alias("concepts"))


# --- tagging ------------------------------------------------------------------


@query
def concept_tags(spark, sf_dir):
    docs = views.cleaned_questions(spark, sf_dir)
    tags = views.tagged(docs, views.dictionary(docs))
    named = tags.select("id", F.array_join("concepts", ",").alias("concepts"))
    every = views.questions(spark, sf_dir).select("id")
    return every.join(named, "id", "left").select(
        "id", F.coalesce("concepts", F.lit("")).alias("concepts")
    )


@query
def concept_frequency(spark, sf_dir):
    docs = views.cleaned_questions(spark, sf_dir)
    return profile.concept_frequency(views.tagged(docs, views.dictionary(docs)))


@query
def concept_onehot(spark, sf_dir):
    docs = views.cleaned_questions(spark, sf_dir)
    tags = views.tagged(docs, views.dictionary(docs)).select("id", "flags")
    # A cache that lacks every fourth row: those get zeros.
    cache = tags.where(F.col("id") % 4 != 0)
    rows = views.questions(spark, sf_dir).select("id").join(cache, "id", "left")
    return rows.select("id", *concept_columns(F.col("flags")))


@query
def concept_roundtrip(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    names = F.array(
        F.element_at(F.array(*map(F.lit, CONCEPTS)), (F.col("event_id") % 15 + 1).cast("int")),
        F.element_at(
            F.array(*map(F.lit, ["Árvores", "força-bruta", "Busca Binária", "outro", ""])),
            (F.col("user_id") % 5 + 1).cast("int"),
        ),
    )
    flags = events.select("event_id", one_hot(names).alias("flags"))
    return flags.select("event_id", F.array_join(concept_set(F.col("flags")), ",").alias("concepts"))


@query
def few_shot_sample(spark, sf_dir):
    chosen = folds.few_shot_sample(views.training(spark, sf_dir, 5), per_class=2)
    return chosen.select(
        "id", "label", F.col("rank").cast("int").alias("rank"), F.col("text").alias("example")
    )


@query
def few_shot_label(spark, sf_dir):
    # Every document gets a label, also one without any words.
    texts = views.wide_questions(spark, sf_dir).select("id", "source", "text")
    docs = vectors.with_words(texts, keep_empty=True).persist()
    model = vectors.fit_tfidf(docs)
    chosen = folds.few_shot_sample(views.training(spark, sf_dir, 5), per_class=1)
    examples = model.transform(chosen.withColumn("query", F.col("id")))
    prepared = similarity.prepare(examples, ("query", "label"))
    rows = similarity.prepare(model.transform(docs))
    return tagging.label_by_example(rows, prepared, model, keep=("id",))


@query
def pack_requests(spark, sf_dir):
    packs = tagging.pack_requests(views.questions(spark, sf_dir), pack_size=10)
    return packs.select("pack", "n", "first_id", "last_id", F.md5("body").alias("body_md5"))


@query
def pack_requests_by_size(spark, sf_dir):
    """Packs of at most ten statements and 20,000 characters."""
    packs = packing.pack_by_size(views.questions(spark, sf_dir), budget=20_000, pack_size=10)
    return packs.select("pack", "n", "first_id", "last_id", "n_chars", F.md5("body").alias("body_md5"))


@query
def request_prompts(spark, sf_dir):
    body = tagging.request(F.col("text"), CONCEPTS, "conceitos")
    return views.questions(spark, sf_dir).select(
        "id", F.length(body).alias("n_chars"), F.md5(body).alias("body_md5")
    )


@query
def parse_replies(spark, sf_dir):
    raw = views.replies(spark, sf_dir)
    parsed = raw.select(
        "id", tagging.parse_reply(F.col("raw"), "struct<id: bigint, dificuldade: string>").alias("r")
    )
    return parsed.select(
        "id", F.col("r.id").alias("reply_id"), F.col("r.dificuldade").alias("dificuldade")
    )


@query
def match_replies(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    requests = events.select(
        F.floor(F.col("event_id") / 10).alias("pack"),
        (F.col("event_id") % 10 + 1).alias("position"),
    )
    # Every third position is not covered, every seventh reply is blank, some come twice.
    answers = requests.where(F.col("position") % 3 != 0).select(
        "pack",
        "position",
        F.when((F.col("pack") + F.col("position")) % 7 == 0, "")
        .otherwise(F.concat(F.lit("v"), F.col("position").cast("string")))
        .alias("answer"),
        F.lit(1).alias("reply_no"),
    )
    again = answers.where(F.col("position") % 5 == 0).select(
        "pack", "position", F.lit("again").alias("answer"), F.lit(2).alias("reply_no")
    )
    return tagging.match_replies(requests, answers.unionByName(again), "answer")


@query
def pending_items(spark, sf_dir):
    items = views.questions(spark, sf_dir).select("id", "source")
    cache = views.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return tagging.pending(items, cache)


def _label_cache(spark, sf_dir) -> DataFrame:
    """Two runs of a labeller over the labelled rows; the later one wins."""
    return views.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.inline(
            F.array(
                F.struct(F.lit("medio").alias("pred"), F.lit(1).alias("run")),
                F.struct(
                    F.when(F.col("quality") == 1, "facil").otherwise("dificil").alias("pred"),
                    F.lit(2).alias("run"),
                ),
            )
        ),
    )


@query
def cached_predictions(spark, sf_dir):
    items = views.questions(spark, sf_dir).select("id", "source")
    return tagging.align(items, _label_cache(spark, sf_dir), "pred", "run")


@query
def cache_coverage(spark, sf_dir):
    items = views.questions(spark, sf_dir).select("id", "source")
    return metrics.coverage(tagging.align(items, _label_cache(spark, sf_dir), "pred", "run"))


def _two_sources(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Documents and benchmark items, whose ids repeat, and a cache of the former alone."""
    docs = views.questions(spark, sf_dir).select("id", "source")
    asked = views.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("id"), F.lit("benchmark").alias("source")
    )
    return docs.unionByName(asked), _label_cache(spark, sf_dir).join(docs, "id")


@query
def pending_by_source(spark, sf_dir):
    return tagging.pending(*_two_sources(spark, sf_dir))


@query
def cached_by_source(spark, sf_dir):
    items, cache = _two_sources(spark, sf_dir)
    return tagging.align(items, cache, "pred", "run")


@query
def resume_labels(spark, sf_dir):
    """Labels of all documents and benchmark items: half cached, the cache compacted, the rest resumed."""
    items, known = _two_sources(spark, sf_dir)
    cache = CacheTable(spark, f"{shared_folder(spark)}/cache-{uuid.uuid4().hex}", "source string, id long, pred string", buckets=8)
    cache.publish(known.where("run = 1").select("source", "id", "pred"))
    cache.publish(known.where("run = 2").select("source", "id", "pred"))
    cache.compact("pred")
    answer = F.when(F.col("id") % 2 == 0, "facil").otherwise("muito_dificil")
    return cache.resume(items, lambda todo: todo.withColumn("pred", answer), "pred")


# --- models (rows only: iterative solvers) ------------------------------------


def _small_grid(family: models.Family) -> list[dict]:
    return {
        "logistic": [{"C": 1.0, "max_iter": 20}],
        "forest": [{"trees": 20, "max_depth": 8}],
    }[family.name]


def _model_rows(spark, sf_dir, n_splits: int = 3) -> DataFrame:
    folded = folds.with_folds(views.training(spark, sf_dir), n_splits=n_splits)
    return vectors.with_words(folded).persist()


@query
def logistic_oof(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    return models.out_of_fold(rows, models.LOGISTIC, _small_grid(models.LOGISTIC))


@query
def svm_oof(spark, sf_dir):
    """Every setting of the family's grid, on five folds."""
    return models.out_of_fold(_model_rows(spark, sf_dir, n_splits=5), models.SVM)


@query
def forest_oof(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    return models.out_of_fold(rows, models.FOREST, _small_grid(models.FOREST))


@query
def knn_oof(spark, sf_dir):
    return models.knn_out_of_fold(_model_rows(spark, sf_dir))


@query
def score_unlabelled(spark, sf_dir):
    rows = views.labelled(spark, sf_dir).select(
        "id", "source", "text", collapse(F.col("label")).alias("label")
    )
    catalog = vectors.with_words(rows, keep_empty=True).persist()
    known = catalog.where("label IS NOT NULL")
    model = vectors.fit_tfidf(known)
    fitted = models.fit_classifier(
        model.transform(known), models.LOGISTIC, {"C": 1.0, "max_iter": 20}
    )
    return models.fill_labels(catalog, fitted, model).select("id", "source", "label", "effective")


@query
def compare_approaches(spark, sf_dir):
    words = views.dictionary(views.cleaned_questions(spark, sf_dir))
    rows = vectors.with_words(views.training(spark, sf_dir))
    return evaluation.compare(
        views.tagged(rows, words), params={"C": 1.0, "max_iter": 20}
    )


@query
def inference_table(spark, sf_dir):
    catalog = views.catalog(spark, sf_dir)
    words = views.dictionary(catalog)
    rows = vectors.with_words(views.training(spark, sf_dir)).persist()
    scorer = vectors.fit_tfidf(rows)
    classifier = models.fit_classifier(
        scorer.transform(rows), models.LOGISTIC, {"C": 1.0, "max_iter": 20}
    )
    new = views.new_questions(spark, sf_dir).select(
        F.col("query").alias("id"), F.lit("benchmark").alias("source"), "text"
    )
    return inference.recommend_new(
        views.tagged(vectors.with_words(new), words),
        views.tagged(catalog, words),
        scorer,
        classifier,
        n_levels=3,
    )
