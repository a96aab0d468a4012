"""The given tables in the roles the engine works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions.concepts import one_hot
from gradus.functions.labels import collapse, level_of, note_of
from gradus.functions.text import clean_text, word_tokens
from gradus.operators.quantiles import quantiles
from gradus.operators.tagging import tag_by_dictionary
from gradus.operators.vectors import with_words, word_totals
from gradus.schema import CONCEPTS
from gradus.session import durable, spread

QUANTILES = (0.2, 0.4, 0.6, 0.8)
# Settings of the score grid: every source with 3 and 5 levels, and one that does not occur.
SETTINGS = [f"src{i}_{n}" for i in range(20) for n in (3, 5)] + ["missing_3"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as (id, source, lang, text, n_chars)."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "source", "lang", "text", "n_chars"
    )


def wide_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, spread over the cores when the file is too small to be."""
    return spread(questions(spark, sf_dir), "id")


def cleaned_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, source, words), cleaned once for queries that need the words repeatedly."""
    docs = wide_questions(spark, sf_dir).select("id", "source", "text")
    return with_words(docs).persist()


def stored_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, stored: cached words of a large corpus fill the memory of the executors."""
    return durable(with_words(wide_questions(spark, sf_dir).select("id", "source", "text")))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")


def _label(spark: SparkSession, sf_dir: str) -> Column:
    """5-level label: the quintile of the text length among the rows in labels.

    The four cuts are fetched once and become constants of the plan.
    """
    marked = _marked(spark, sf_dir)
    sizes = questions(spark, sf_dir).select("id", "n_chars").join(marked, "id", "left_semi")
    cuts = quantiles(sizes, "n_chars", QUANTILES).first()
    above = [(F.col("n_chars") > cut).cast("int") for cut in (cuts.q if cuts else ())]
    return level_of(sum(above, F.lit(1)))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """questions plus ``label``, NULL for rows that are not in labels."""
    label = F.when(F.col("quality").isNotNull(), _label(spark, sf_dir))
    docs = questions(spark, sf_dir).join(_marked(spark, sf_dir), "id", "left")
    return docs.withColumn("label", label).drop("quality")


def supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``labelled`` that have a label."""
    docs = questions(spark, sf_dir).join(_marked(spark, sf_dir).drop("quality"), "id")
    return docs.withColumn("label", _label(spark, sf_dir))


def training(spark: SparkSession, sf_dir: str, n_levels: int = 3) -> DataFrame:
    """The labelled rows as (id, text, label)."""
    label = F.col("label") if n_levels == 5 else collapse(F.col("label"))
    return supervised(spark, sf_dir).select("id", "text", label.alias("label"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as (question_id, rating 1..5)."""
    rating = F.lit(1) + F.pmod(F.col("l_quantity").cast("int") - 1, F.lit(5))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("question_id"), rating.alias("rating")
    )


JUDGE_SPELLING = {
    "1-URGENT": "Super Difícil",
    "2-HIGH": " DIFÍCIL",
    "3-MEDIUM": "Médio",
    "4-NOT SPECIFIED": "não informado",
    "5-LOW": "Fácil",
}


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as (id, raw_label), the priority spelled like a judge's label."""
    spelled = F.col("o_orderpriority")
    cases = F
    for raw, spelling in JUDGE_SPELLING.items():
        cases = cases.when(spelled == raw, spelling)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), cases.alias("raw_label")
    )


def dictionary(docs: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """(word, concept, df): every word of two documents or more, dealt to the taxonomy by a hash."""
    if totals is None:
        totals = word_totals(docs if "words" in docs.columns else with_words(docs))
    words = totals.where("df >= 2 AND term != ''")
    number = F.conv(F.substring(F.md5("term"), 1, 7), 16, 10).cast("int") % len(CONCEPTS)
    names = F.array(*map(F.lit, CONCEPTS))
    concept = F.element_at(names, number + 1).alias("concept")
    return durable(words.select(F.col("term").alias("word"), concept, "df"))


def tagged(df: DataFrame, words: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``concepts`` (sorted names) and ``flags`` (0/1)."""
    keys = ["query"] if "query" in df.columns else [c for c in ("source", "id") if c in df.columns]
    if "words" in df.columns:
        found = tag_by_dictionary(df, words, keys)
    else:
        tokens = word_tokens(clean_text(F.col(text)))
        found = tag_by_dictionary(df.withColumn("words", tokens), words, keys).drop("words")
    return found.withColumn("flags", one_hot(F.col("concepts")))


def new_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """benchmark items as (query, text, level): a level in 1..3, unknown for some."""
    number = F.col("item_id")
    level = F.when(number % 7 != 0, (number % 3 + 1).cast("int"))
    return table(spark, sf_dir, "benchmark").select(
        number.alias("query"), "text", level.alias("level")
    )


def catalog_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, source, level) on the 3-level scale, NULL without a label."""
    three = collapse(F.col("label"), keep_unknown=True)
    rows = labelled(spark, sf_dir)
    return rows.select("id", "source", note_of(three, 3).cast("int").alias("level"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned catalog with its levels: (id, source, words, level)."""
    levels = catalog_levels(spark, sf_dir).drop("source")
    words = with_words(wide_questions(spark, sf_dir).select("id", "source", "text"))
    return words.join(levels, "id", "left").persist()


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchases as (query = user, source, id): the document with the event's number."""
    docs = questions(spark, sf_dir).select("id", "source")
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    bought = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    solved = bought.select(
        F.col("user_id").alias("query"), F.pmod(F.col("event_id"), n_docs).alias("id")
    )
    return solved.distinct().join(docs, "id").select("query", "source", "id")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everyone with an event, as (query, level)."""
    return (
        table(spark, sf_dir, "events")
        .select(F.col("user_id").alias("query"))
        .distinct()
        .withColumn("level", (F.col("query") % 3 + 1).cast("int"))
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as (id, raw): JSON replies, some fenced, in prose, cut off or garbage."""
    body = F.concat(
        F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "dificuldade": "'),
        F.col("event_type"), F.lit('"}'),
    )
    kind = F.col("event_id") % 5
    raw = (
        F.when(kind == 0, body)
        .when(kind == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("Here it is: "), body, F.lit(" - done")))
        .when(kind == 3, F.concat(F.lit(" "), body, F.lit("\n")))
        .otherwise(F.concat(F.lit("no idea, "), F.col("event_type")))
    )
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), raw.alias("raw"))
