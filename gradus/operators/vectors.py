"""TF-IDF as group-bys and row-local transformers.

Fitting counts words, then the n-grams of frequent words as numbers; every task counts
its own before they are shuffled. The vocabulary is at most ``max_features`` terms, so the fitted
model fits on the driver, and transforming needs no join and no shuffle.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.functions.folding import word_folding
from gradus.functions.text import lower_prose, ngrams, stopwords
from gradus.operators import grams
from gradus.schema import MAX_FEATURES, MIN_DF, NGRAM_MAX
from gradus.session import durable

#: Parts of a fold's terms that are ranked side by side.
BUCKETS = 64
#: Words whose n-grams are counted by number; with more of them n-grams are counted as strings.
NUMBERED = 65_536


def words_of(text: Column, drop: tuple[str, ...] | None = None) -> Column:
    """``word_tokens`` of ``clean_text``, for whole tables: folded and split a batch at a time."""
    folding, dropped = grams.Folding(word_folding()), stopwords() if drop is None else tuple(drop)

    @F.arrow_udf(returnType="array<string>")
    def split(texts: pa.Array) -> pa.Array:
        return grams.split_words(texts, folding, dropped)

    return split(lower_prose(text))


def with_words(
    df: DataFrame,
    text: str = "text",
    drop: tuple[str, ...] | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """Replaces ``text`` by ``words``, the cleaned tokens without stop words.

    Rows whose text is missing, or has no words left, drop out unless ``keep_empty``.
    Cleaning is the costly step: tables that are fitted, transformed and tagged should be
    cleaned once, here, and kept (persisted or written) in this form.
    """
    words = words_of(F.col(text), drop)
    # A one-element explode: the optimizer cannot push filters on the words through it,
    # which would clean every text twice.
    if keep_empty:
        return df.withColumn("words", F.explode(F.array(words))).drop(text)
    return (
        df.where(F.col(text).isNotNull() & (F.trim(text) != ""))
        .withColumn("words", F.explode(F.array(words)))
        .where(F.size("words") > 0)
        .drop(text)
    )


def with_terms(
    df: DataFrame,
    text: str = "text",
    ngram_max: int = NGRAM_MAX,
    drop: tuple[str, ...] | None = None,
    out: str = "terms",
) -> DataFrame:
    """Adds the n-grams of the words; from ``words`` if there, else from the text."""
    if "words" in df.columns:
        cleaned = df.where(F.size("words") > 0)
    else:
        cleaned = with_words(df, text, drop)
    return cleaned.withColumn(out, ngrams(F.col("words"), ngram_max))


def term_totals(docs: DataFrame, terms: str = "terms", by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., term, total, df): occurrences and documents per term.

    The terms of a row are sorted, so that the first occurrence of each is the one that
    differs from its neighbour: documents are counted without grouping by document.
    """
    each, again = _occurrences(docs, terms, by)
    return each.groupBy(*by, "term").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(again, 0).otherwise(1)).alias("df"),
    )


def word_totals(docs: DataFrame) -> DataFrame:
    """(term, total, df) of the ``words``, and '' with the number of rows as both.

    Every task sums its own words batch by batch; rows without words are not counted.
    """
    counts = docs.where(F.size("words") > 0).select("words").mapInArrow(
        grams.count_words, "term string, total long, df long"
    )
    return counts.groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


def _occurrences(docs: DataFrame, terms: str, by: tuple[str, ...]) -> tuple[DataFrame, Column]:
    """(by..., term, ...), a row for each term of a row of ``docs``, and whether it occurred there before."""
    ordered = docs.select(*by, F.sort_array(terms).alias("_sorted"))
    # The outer form: for a plain explode the optimizer adds a filter on the array's
    # size, and computes the n-grams once more for it.
    each = ordered.select(*by, "_sorted", F.posexplode_outer("_sorted").alias("_pos", "term"))
    again = F.get("_sorted", F.col("_pos") - 1) == F.col("term")
    return each.where(F.col("term").isNotNull()), again


def vocabulary(
    docs: DataFrame,
    max_features: int = MAX_FEATURES,
    min_df: int = MIN_DF,
    terms: str = "terms",
) -> DataFrame:
    """(term, total, df) of the kept terms: df >= min_df, then the most frequent ones.

    Ties at the cut go to the alphabetically first term. A top-n, not a global sort.
    """
    return (
        term_totals(docs, terms)
        .where(F.col("df") >= min_df)
        .orderBy(F.desc("total"), "term")
        .limit(max_features)
    )


def _largest(counts: DataFrame, n: int, by: tuple[str, ...] = ()) -> DataFrame:
    """The ``n`` first terms of each group: '' (the number of documents), then by total and term.

    Every bucket of terms gives its own ``n`` first before they meet, so what one task gathers
    for a group is buckets x n rows, however large the vocabulary is.
    """
    order = (F.desc(F.col("term") == ""), F.desc("total"), "term")
    bucket = F.pmod(F.hash("term"), F.lit(BUCKETS))
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    first = counts.withColumn("_bucket", bucket).withColumn("rn", F.row_number().over(inside)).where(F.col("rn") <= n)
    over = Window.partitionBy(*by).orderBy(*order)
    return first.drop("_bucket").withColumn("rn", F.row_number().over(over)).where(F.col("rn") <= n)


def idf(n_docs: int, df: int) -> float:
    """Smoothed inverse document frequency."""
    return math.log((1 + n_docs) / (1 + df)) + 1


@dataclass
class TfidfModel:
    """A fitted vocabulary with its weights (at most ``max_features`` entries)."""

    terms: list[str]
    weights: list[float]
    n_docs: int
    ngram_max: int = NGRAM_MAX
    drop: tuple[str, ...] | None = None
    stages: PipelineModel = field(init=False, repr=False)

    def __post_init__(self) -> None:
        # An empty vocabulary is not allowed by the counter; "" is never a term.
        self.stages = PipelineModel(
            [
                CountVectorizerModel.from_vocabulary(
                    self.terms or [""], inputCol="terms", outputCol="_tf"
                ),
                ElementwiseProduct(
                    scalingVec=Vectors.dense(self.weights or [0.0]),
                    inputCol="_tf",
                    outputCol="_tfidf",
                ),
                Normalizer(p=2.0, inputCol="_tfidf", outputCol="features"),
            ]
        )

    @property
    def size(self) -> int:
        return max(1, len(self.terms))

    def transform_terms(self, df: DataFrame) -> DataFrame:
        """``features`` (L2-normalised sparse vector) from a ``terms`` column."""
        return self.stages.transform(df).drop("_tf", "_tfidf", "terms")

    def transform(self, df: DataFrame, text: str = "text") -> DataFrame:
        """``features`` for new rows; unseen terms are dropped, empty rows stay zero."""
        words = F.col("words") if "words" in df.columns else words_of(F.col(text), self.drop)
        split = [term.split(" ") for term in self.terms]
        known = sorted({word for term in split for word in term})
        if not grams.fits(len(known), self.ngram_max):
            return self.transform_terms(df.withColumn("terms", ngrams(words, self.ngram_max)))
        code = {word: i for i, word in enumerate(known, 1)}
        numbers = np.zeros(len(split), "int64")
        for place, term in enumerate(split):
            if len(term) <= self.ngram_max:
                for word in term:
                    numbers[place] = numbers[place] * (len(known) + 1) + code[word]
        order = np.argsort(numbers, kind="stable")
        weights = np.array(self.weights or [0.0])
        shared = df.sparkSession.sparkContext.broadcast((pa.array(known, "string"), numbers[order], order, weights))
        ngram_max = self.ngram_max

        @F.arrow_udf(returnType=VectorUDT())
        def vector(rows: pa.Array) -> pa.Array:
            return grams.entries(rows, *shared.value, ngram_max)

        size = {"ml_attr": {"num_attrs": self.size}}
        return df.withColumn("features", vector(words)).withMetadata("features", size)

    def long(self, vectors: DataFrame, *keys: str) -> DataFrame:
        """(keys..., term, w), one row per non-zero entry."""
        names = F.from_json(F.lit(json.dumps(self.terms)), "array<string>")
        entries = sparse_entries(vectors, *keys).select(
            *keys, F.inline(F.arrays_zip("idx", "w"))
        )
        return entries.select(*keys, F.get(names, F.col("idx")).alias("term"), "w")


def sparse_entries(df: DataFrame, *keep: str, features: str = "features") -> DataFrame:
    """The vector column as plain arrays ``idx`` and ``w``."""
    # Behind a one-element explode, as in with_words: a filter on the entries would else be
    # pushed below them and compute the vector a second time.
    raw = df.select(*keep, F.explode(F.array(F.unwrap_udt(features))).alias("_raw"))
    return raw.select(*keep, F.col("_raw.indices").alias("idx"), F.col("_raw.values").alias("w"))


def fit_tfidf(
    docs: DataFrame,
    max_features: int = MAX_FEATURES,
    ngram_max: int = NGRAM_MAX,
    min_df: int = MIN_DF,
    text: str = "text",
    drop: tuple[str, ...] | None = None,
    totals: DataFrame | None = None,
) -> TfidfModel:
    """Fit on a corpus: words first, then the n-grams of words that are frequent enough.

    An n-gram occurs no more often, and in no more rows, than each of its words. So once the
    ``max_features`` first words are known, only n-grams of words that occur as often as the
    last of them can be among the first terms; these words are numbered, and numbers counted.
    ``totals``: the corpus's ``word_totals``, where they are known already.
    """
    cleaned = docs if "words" in docs.columns else with_words(docs, text, drop).select("words").persist()
    try:
        singles = durable(word_totals(cleaned)) if totals is None else totals
        n_docs = singles.where("term = ''").agg(F.sum("df")).first()[0] or 0
        kept = singles.where((F.col("df") >= min_df) & (F.col("term") != ""))
        first = _first_terms(kept, max_features, "term")
        least = first[-1].total if first and len(first) == max_features else 0
        if ngram_max > 1:
            words = [r.term for r in kept.where(F.col("total") >= least).select("term").limit(NUMBERED + 1).collect()]
            if len(words) <= NUMBERED and grams.fits(len(words), ngram_max):
                found = _numbered_grams(cleaned, sorted(words), ngram_max, min_df, least, max_features)
                ranked = [(r.term, r.total, r.df) for r in first] + found
                ranked.sort(key=lambda r: (-r[1], r[0]))
                return _model([("", n_docs), *[(term, df) for term, _, df in ranked[:max_features]]], ngram_max, drop)
            # Too many words as frequent as the last: every n-gram is counted, as a string.
            totals = term_totals(with_terms(cleaned, ngram_max=ngram_max)).where(F.col("df") >= min_df)
            first = _first_terms(totals, max_features, "term")
        return _model([("", n_docs), *[(r.term, r.df) for r in first]], ngram_max, drop)
    finally:
        if cleaned is not docs:
            cleaned.unpersist()


def _first_terms(counts: DataFrame, n: int, name: str) -> list:
    """The ``n`` most frequent rows of (name, total, df), then by name.

    One task gathers the first rows of all others; collected as they are, they would meet
    in the driver, partitions x n of them.
    """
    return counts.orderBy(F.desc("total"), name).limit(n).coalesce(1).collect()


def _numbered_grams(
    docs: DataFrame, words: list[str], ngram_max: int, min_df: int, least: int, n: int
) -> list[tuple[str, int, int]]:
    """(term, total, df) of the first ``n`` n-grams of ``words`` that occur ``least`` times or more.

    Ties at the end are broken by name, as everywhere.
    """
    shared = docs.sparkSession.sparkContext.broadcast((pa.array(words, "string"), words))

    def count(batches):
        return grams.count_grams(batches, shared.value[0], ngram_max)

    @F.arrow_udf(returnType="string")
    def named(numbers: pa.Array) -> pa.Array:
        return pa.array([grams.gram_name(x, shared.value[1]) for x in numbers.to_pylist()], "string")

    counts = docs.where(F.size("words") > 0).select("words").mapInArrow(count, "gram long, total long, df long")
    sums = counts.groupBy("gram").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
    enough = sums.where((F.col("total") >= least) & (F.col("df") >= min_df))
    rows = _first_terms(enough.select(named("gram").alias("term"), "total", "df"), n, "term")
    shared.destroy()
    return [(r.term, r.total, r.df) for r in rows]


def _model(
    rows: list[tuple[str, int]], ngram_max: int, drop: tuple[str, ...] | None
) -> TfidfModel:
    counts = dict(rows)
    n_docs = counts.pop("", 0)
    return TfidfModel(
        list(counts), [idf(n_docs, df) for df in counts.values()], n_docs, ngram_max, drop
    )


def fold_term_counts(folded: DataFrame, terms: str = "terms") -> DataFrame:
    """(fold, term, total, df) of the training part of every fold, in one job.

    Training counts of a fold are the overall counts minus those inside the fold.
    """
    # Folds are few: their counts are columns, so terms are shuffled once and counted as numbers.
    each, again = _occurrences(folded, terms, ("fold",))
    first = F.when(again, 0).otherwise(1)
    kind = folded.schema["fold"].dataType
    folds = [F.lit(f).cast(kind) for f in sorted(folded.agg(F.collect_set("fold")).first()[0])]
    sums = {"total": F.count(F.lit(1)), "df": F.sum(first)}
    for i, fold in enumerate(folds):
        sums[f"total_{i}"] = F.sum(F.when(F.col("fold") == fold, 1).otherwise(0))
        sums[f"df_{i}"] = F.sum(F.when(F.col("fold") == fold, first).otherwise(0))
    per_term = each.groupBy("term").agg(*[x.alias(name) for name, x in sums.items()])
    outside = [
        F.struct(fold.alias("fold"), *[(F.col(c) - F.col(f"{c}_{i}")).alias(c) for c in ("total", "df")])
        for i, fold in enumerate(folds)
    ]
    training = F.explode(F.array(*outside)).alias("_of") if folds else F.lit(None).cast(
        f"struct<fold:{kind.simpleString()},total:bigint,df:bigint>"
    ).alias("_of")
    return per_term.select("term", training).select("_of.fold", "term", "_of.total", "_of.df").where("df > 0")


def fit_folds(
    folded: DataFrame,
    max_features: int = MAX_FEATURES,
    ngram_max: int = NGRAM_MAX,
    min_df: int = MIN_DF,
    text: str = "text",
    drop: tuple[str, ...] | None = None,
) -> dict[int, TfidfModel]:
    """One leak-free model per fold, all from one job over the corpus.

    The driver receives at most folds x (max_features + 1) rows.
    """
    terms = with_terms(folded, text, ngram_max, drop).select(
        "fold", F.concat("terms", F.array(F.lit(""))).alias("terms")
    )
    counts = fold_term_counts(terms).where((F.col("df") >= min_df) | (F.col("term") == ""))
    rows = _largest(counts, max_features + 1, ("fold",)).collect()
    rows.sort(key=lambda row: (row.fold, row.rn))
    per_fold: dict[int, list[tuple[str, int]]] = {}
    for row in rows:
        per_fold.setdefault(row.fold, []).append((row.term, row.df))
    return {fold: _model(pairs, ngram_max, drop) for fold, pairs in per_fold.items()}
