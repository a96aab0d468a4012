"""From raw documents to tokens: one stage after the other, a table between them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.llm import bpe, pii, superminhash, toxicity, wu_manber
from gradus.llm.queries import TOKENIZER
from gradus.llm.staging import Stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on the labelled ones, does not reject."""
    chain = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, chain).where(~F.col("is_toxic")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: shingles of five words, a similarity of 0.8 or more."""
    return superminhash.keep_one(docs, shingle_words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which benchmark windows do not hit a twentieth of the words."""
    found = wu_manber.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, identifiers replaced by their kind; ``n_chars`` counts the new text."""
    hidden = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        hidden = hidden.withColumn("n_chars", F.char_length("text").cast(kind))
    return hidden.select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its tokens in place of its text, and whether they decode to it."""
    path, pattern = public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN
    made = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path, pattern)
    return made.drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("tokens", tokenize),
]

#: Toxicity and similarity groups cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written before the next stage reads it."""
    stage = Stage(spark)
    docs = _table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage.write(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
