"""CSV with newlines inside quotes, one large file read by many tasks.

Lines are read as text, which splits at any byte. Whether a line begins inside quotes depends
on all quotes before it: a line with an odd number of them turns the state over. Every
split counts its own odd lines, the counts are added up over the splits of a file, and each line
then knows the state it begins in. Records of one line, nearly all, stay where they were read;
only the lines of longer records are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LINE = "file string, start long, value string, place long, odd boolean, turns long"


def _lines(spark: SparkSession, path: str | list[str], quote: str) -> DataFrame:
    """Every line with its place in its split, whether its quotes are odd, odd lines before it."""
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, place, turns = None, 0, 0
        for batch in batches:
            files, starts = batch.column("file"), batch.column("start")
            odd = pc.count_substring(batch.column("value"), quote).to_numpy(zero_copy_only=False) % 2 == 1
            new = np.ones(batch.num_rows, dtype=bool)
            if batch.num_rows > 1:
                same = pc.and_(pc.equal(files[1:], files[:-1]), pc.equal(starts[1:], starts[:-1]))
                new[1:] = ~same.to_numpy(zero_copy_only=False)
            if batch.num_rows:
                new[0] = split != (files[0].as_py(), starts[0].as_py())
            cuts = np.flatnonzero(new).tolist()
            places, before = np.empty(batch.num_rows, np.int64), np.empty(batch.num_rows, np.int64)
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if begin in cuts:
                    place, turns = 0, 0
                places[begin:end] = place + np.arange(end - begin)
                sums = turns + np.cumsum(odd[begin:end])
                before[begin:end] = sums - odd[begin:end]
                if end > begin:
                    place, turns = place + end - begin, int(sums[-1])
            if batch.num_rows:
                split = files[-1].as_py(), starts[-1].as_py()
            yield pa.RecordBatch.from_arrays(
                [files, starts, batch.column("value"), pa.array(places), pa.array(odd), pa.array(before)],
                names=["file", "start", "value", "place", "odd", "turns"],
            )

    return raw.mapInArrow(run, _LINE)


def csv_records(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """(file, value, first): the records as text; ``first`` marks each file's first one.

    Quotes inside a value are doubled. A quote that is never closed makes the rest of its
    file one record, as it does for any reader.
    """
    lines = _lines(spark, path, quote)
    sums = lines.groupBy("file", "start").agg(F.count_if("odd").alias("n"))
    # One row for each split.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("file", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    known = lines.join(offsets, ["file", "start"]).withColumn("turn", F.col("earlier") + F.col("turns"))
    first = (F.col("start") == 0) & (F.col("place") == 0)
    inside = F.col("turn") % 2 == 1
    single = known.where(~inside & ~F.col("odd")).select("file", "value", first.alias("first"))
    parts = F.sort_array(F.collect_list(F.struct("start", "place", "value")))
    longer = known.where(inside | F.col("odd")).groupBy("file", F.floor(F.col("turn") / 2).alias("record")).agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"), F.max(first).alias("first")
    )
    return single.union(longer.select("file", "value", "first"))


def read_csv_split(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, sep: str = ","
) -> DataFrame:
    """The rows of CSV files whose values hold newlines, quotes and separators.

    Equal to the multi-line reader, but a file is as many tasks as it has splits. With
    ``header`` each file's first record is left out. Blank lines between records are no
    rows; a record ending in CR LF loses both.
    """
    records = csv_records(spark, path)
    if header:
        records = records.where(~F.col("first"))
    text = F.regexp_replace("value", "\r$", "")
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\u0001", "maxCharsPerColumn": "-1"}
    parsed = records.where(F.trim(text) != "").select(F.from_csv(text, schema.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    return parsed.select("r.*")
