"""Catalog tables, the input contract, caches and report sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.sources.files import require


def catalog_union(sources: dict[str, DataFrame]) -> DataFrame:
    """(source, id, text, label) of every source; a source without labels gets NULLs."""
    if not sources:
        raise ValueError("no sources given")
    parts = []
    for name, df in sources.items():
        require(df, ["id", "text"])
        kept = [c for c in ("id", "text", "label") if c in df.columns]
        parts.append(df.select(F.lit(name).alias("source"), *kept))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if "label" not in whole.columns:
        whole = whole.withColumn("label", F.lit(None).cast("string"))
    return whole.select("source", "id", "text", "label")


def read_catalog(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """The named sources of a table written by ``write_catalog`` (pruned by partition)."""
    catalog = spark.read.parquet(root).where(F.col("source").isin(*names))
    found = {row.source for row in catalog.select("source").distinct().collect()}
    if absent := sorted(set(names) - found):
        raise FileNotFoundError(f"sources not in {root}: {absent}")
    return catalog


def labelled_only(df: DataFrame, label: str = "label", wanted: bool = True) -> DataFrame:
    """The rows with a label (or, not ``wanted``, without); an error when there is none."""
    has = F.col(label).isNotNull()
    rows = df.where(has if wanted else ~has)
    if rows.isEmpty():
        raise ValueError(f"no {'labelled' if wanted else 'unlabelled'} rows")
    return rows


def write_catalog(df: DataFrame, root: str, files_per_source: int = 1) -> None:
    """Consolidated table, one partition folder per source.

    A source may hold a third of all rows, so its rows go to ``files_per_source``
    tasks by a hash of the id instead of to one.
    """
    (
        df.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(files_per_source)))
        .repartition("source", "_part")
        .drop("_part")
        .write.mode("overwrite")
        .partitionBy("source")
        .parquet(root)
    )


def contract_report(
    df: DataFrame,
    keys: Sequence[str] = ("id",),
    text: str = "text",
    label: str | None = None,
    scale: Sequence[str] = (),
) -> DataFrame:
    """One row: rows, NULL keys, repeated keys, NULL and blank texts, odd labels.

    Rows are first counted per key with map-side combine, so a key that a third of
    the rows share costs no more than any other.
    """
    require(df, [*keys, text, *([label] if label else [])])
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    odd = F.lit(0)
    if label is not None:
        odd = (F.col(label).isNotNull() & ~F.col(label).isin(*scale)).cast("long")
    blank = F.col(text).isNotNull() & (F.trim(text) == "")
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(text).isNull().cast("long")).alias("null_text"),
        F.sum(blank.cast("long")).alias("blank_text"),
        F.sum(odd).alias("odd_label"),
    )
    repeated = F.when(~null_key, F.col("n") - 1).otherwise(0)
    return per_key.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
            for name, c in {
                "rows": F.col("n"),
                "null_keys": F.when(null_key, F.col("n")).otherwise(0),
                "duplicate_keys": repeated,
                "null_text": F.col("null_text"),
                "blank_text": F.col("blank_text"),
                "odd_labels": F.col("odd_label"),
            }.items()
        ]
    )


def check_contract(df: DataFrame, **options) -> DataFrame:
    """``df`` itself when the report shows no violation, else an error with the counts."""
    counts = contract_report(df, **options).first().asDict()
    broken = {name: n for name, n in counts.items() if name != "rows" and n}
    if broken:
        raise ValueError(f"input contract violated: {broken} in {counts['rows']} rows")
    return df


def read_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The cache table, or an empty one with ``schema`` when nothing is written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def publish(df: DataFrame, path: str) -> None:
    """Append one batch; the commit protocol shows all of it or nothing."""
    df.write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Metrics, confusion and comparison tables (small)."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
