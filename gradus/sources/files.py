"""Readers for the raw layouts, and the repair of damaged JSON arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.functions.folding import let
from gradus.functions.text import strip
from gradus.schema import JUDGE_RECORD, QUESTIONS, RATINGS


def read_questions_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType = QUESTIONS
) -> DataFrame:
    """CSV whose statements hold newlines and quotes. The schema is never inferred."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"')


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: T.StructType
) -> DataFrame:
    """A file holding one JSON array of records."""
    return spark.read.json(path, schema=schema, multiLine=True)


def read_statements(spark: SparkSession, folder: str) -> DataFrame:
    """One text file per question, the id in the file name; (id, text).

    Give the folder with or without examples. Files without an id and ``._*``
    left-overs are skipped, undecodable bytes are dropped by the decoder. Of several files
    with one id, such as ``exercise_1`` and ``exercise_01``, the last by name counts.
    """
    name = F.col("_metadata.file_name")
    number = F.regexp_extract(name, r"(?i)exercise_(\d+)", 1)
    files = (
        spark.read.option("pathGlobFilter", "exercise_*.txt")
        .text(folder, wholetext=True)
        .where(~name.startswith("._") & (number != ""))
        .select(
            number.cast("long").alias("id"),
            name.alias("name"),
            strip(F.translate("value", "\ufffd", "")).alias("text"),
        )
    )
    return files.groupBy("id").agg(F.max_by("text", "name").alias("text"))


def read_ratings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rating files; (question_id, rating, batch), batch being the file stem."""
    raw = spark.read.json(path, schema=RATINGS, multiLine=True)
    return raw.select(
        "question_id",
        F.col("difficultylevel").alias("rating"),
        F.regexp_extract("_metadata.file_name", r"(.*)\.json$", 1).alias("batch"),
    )


def repair_json_array(raw: Column) -> Column:
    """Drop a trailing comma and close a missing bracket."""
    body = F.regexp_replace(raw, r"\s+$", "")

    def close(text: Column) -> Column:
        bare = F.regexp_replace(text, ",$", "")
        return let(bare, lambda b: F.when(b.endswith("]"), b).otherwise(F.concat(b, F.lit("\n]"))))

    return let(body, close)


def parse_json_array(raw: Column, element: T.DataType) -> Column:
    """An array of ``element``; a cut-off array is repaired, garbage gives NULL.

    The permissive parser keeps the readable head of a damaged array, so the first
    attempt counts only when the text ends like an array.
    """
    schema = T.ArrayType(element)
    whole = F.regexp_replace(raw, r"\s+$", "")
    return F.coalesce(
        F.when(whole.endswith("]"), F.from_json(raw, schema)),
        F.from_json(repair_json_array(raw), schema),
    )


def _judge_files(spark: SparkSession, path: str | list[str], record: T.StructType) -> DataFrame:
    """(file, records, reason): ``reason`` is NULL if every record of the file was read."""
    name = F.col("_metadata.file_name")
    files = (
        spark.read.option("pathGlobFilter", "*.json")
        .text(path, wholetext=True)
        .where(~name.startswith("feedbacks_") & ~name.startswith("._"))
        .select(name.alias("file"), "value")
    )
    whole = F.regexp_replace("value", r"\s+$", "")
    # The length is NULL unless the text is one well-formed array.
    length = F.coalesce(
        F.when(whole.endswith("]"), F.json_array_length("value")),
        F.json_array_length(repair_json_array(F.col("value"))),
    )
    parsed = files.select(
        "file", length.alias("length"), parse_json_array(F.col("value"), record).alias("records")
    )
    reason = F.when(F.col("length").isNull(), "no JSON array").when(
        F.coalesce(F.size("records"), F.lit(-1)) != F.col("length"), "unreadable records"
    )
    return parsed.select("file", "records", reason.alias("reason"))


def read_judge(
    spark: SparkSession, path: str | list[str], record: T.StructType = JUDGE_RECORD
) -> DataFrame:
    """Judge records in file order: the record's columns plus ``file`` and ``pos``.

    A whole file is one value because a damaged array must be repaired before it is
    parsed; files in JSON-lines layout need no repair and can use ``read_judge_lines``.
    A file that is no array even after the repair is an error that names it;
    ``judge_rejects`` lists all such files. A file without a byte makes no row in Spark's
    reader, so it is passed over.
    """
    files = _judge_files(spark, path, record)
    fault = F.raise_error(F.concat_ws(": ", F.lit("damaged judge file"), "file", "reason"))
    sound = F.when(F.col("reason").isNull(), F.col("records")).otherwise(fault)
    return files.select("file", F.posexplode(sound).alias("pos", "r")).select("file", "pos", "r.*")


def judge_rejects(
    spark: SparkSession, path: str | list[str], record: T.StructType = JUDGE_RECORD
) -> DataFrame:
    """(file, reason) of the files that ``read_judge`` refuses."""
    return _judge_files(spark, path, record).where("reason IS NOT NULL").select("file", "reason")


def read_judge_lines(
    spark: SparkSession, path: str | list[str], record: T.StructType = JUDGE_RECORD
) -> DataFrame:
    """The same columns from JSON lines, which Spark can split within a file.

    ``pos`` orders the rows of a file however its parts are dealt to tasks: the offset of
    the part in the file, then the order within the part.
    """
    pos = F.struct(
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("row"),
    )
    return spark.read.json(path, schema=record).select(
        F.col("_metadata.file_name").alias("file"), pos.alias("pos"), "*"
    )


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` itself, or a clear error naming the absent columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}; available: {df.columns}")
    return df
