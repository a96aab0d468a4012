"""Files that hold one JSON array of records, perhaps cut off, read by many tasks each.

A file is read as text that ends at every ``}``, which splits at any byte. Whether a ``}`` ends a
record depends on all before it: on whether a string is open, and how deep brackets are. Each
split is first run through for both cases, string open or not at its beginning, giving the case
at its end and the change of depth; these effects are composed over the splits of a file, one
row each. Then every split cuts its records where they lie. Only what lies across a bound,
the end of one split and the beginning of the next, is brought together.

The repair is the whole-file reader's: at the end of a file, and there only, a comma may stand and
the closing bracket may lack.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.schema import JUDGE_RECORD

_ESCAPED = re.compile(r"\\.", re.S).sub
_SPACE = r" \t\r\n"


def _effect(piece: str, inside: bool) -> tuple[bool, int]:
    """Whether a string is open after ``piece``, and the brackets it opens less those it closes."""
    parts = _ESCAPED("", piece).split('"')
    depth = 0
    for part in parts[1::2] if inside else parts[::2]:
        depth += part.count("{") + part.count("[") - part.count("]")
    return inside ^ (len(parts) % 2 == 0), depth


def _pieces(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    """(file, name, start, size, value): what stands before each ``}``, in order within a split."""
    meta = F.col("_metadata")
    return (
        spark.read.option("pathGlobFilter", pattern)
        .text(path, lineSep="}")
        .select(
            meta["file_path"].alias("file"), meta["file_name"].alias("name"), meta["file_block_start"].alias("start"),
            meta["file_size"].alias("size"), "value",
        )
        .where(~F.col("name").startswith("feedbacks_") & ~F.col("name").startswith("._"))
    )


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[str], bool]]:
    """(the first ``width`` columns, pieces, whether these are the split's last), split after split."""
    open_run: tuple | None = None
    values: list[str] = []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for *key, value in zip(*columns[:width], columns[-1], strict=True):
            if open_run != tuple(key):
                if open_run is not None:
                    yield open_run, values, True
                open_run, values = tuple(key), []
            values.append(value)
            if len(values) >= 4096:
                yield open_run, values[:-1], False
                values = values[-1:]
    if open_run is not None:
        yield open_run, values, True


_EFFECT = "file string, name string, start long, size long, bytes long, open0 boolean, depth0 long, open1 boolean, depth1 long"


def _effects(pieces: DataFrame) -> DataFrame:
    """One row for each split: its bytes, and its effect in both cases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, rows, size = [[False, 0], [True, 0]], [], 0
        for key, values, last in _runs(batches, 4):
            for value in values:
                size += len(value.encode()) + 1
                for state in states:
                    state[0], depth = _effect(value, state[0])
                    state[1] += depth - (not state[0])
            if last:
                rows.append((*key, size, *states[0], *states[1]))
                states, size = [[False, 0], [True, 0]], 0
        schema = pa.schema(
            [("file", pa.string()), ("name", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()),
             ("open0", pa.bool_()), ("depth0", pa.int64()), ("open1", pa.bool_()), ("depth1", pa.int64())]
        )
        columns = list(zip(*rows, strict=True)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return pieces.mapInArrow(run, _EFFECT)


def _begins(effects: DataFrame) -> DataFrame:
    """(file, start, inside, depth, closed): each split's beginning; ``closed``: a } ends its last piece."""
    rows, begins, of_file = sorted(effects.collect(), key=lambda r: (r.file, r.start)), [], {}
    for r in rows:  # one for each split
        of_file.setdefault(r.file, []).append(r)
    for splits in of_file.values():
        inside, depth, total = False, 0, sum(r.bytes for r in splits)
        for i, r in enumerate(splits):
            closed = i + 1 < len(splits) or total == r.size
            begins.append((r.file, r.start, inside, depth, closed))
            inside, change = (r.open1, r.depth1) if inside else (r.open0, r.depth0)
            depth += change
    return effects.sparkSession.createDataFrame(begins, "_file string, _start long, inside boolean, depth long, closed boolean")


_PART = "file string, name string, start long, place long, kind int, text string"


def _parts(pieces: DataFrame, begins: DataFrame) -> DataFrame:
    """Whole records (kind 0), a split's text up to its first record's end (1), and after its last (2)."""
    same = (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start"))
    # One row for each split.
    known = pieces.join(F.broadcast(begins), same).select("file", "name", "start", "inside", "depth", "closed", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        for key, values, last in _runs(batches, 6):
            file, name, start, inside, depth, closed = key
            if state is None:
                state = [inside, depth, 0, []]  # string open, depth, records ended, text since the last end
            rows = []
            for i, value in enumerate(values):
                ends = closed or not (last and i + 1 == len(values))
                state[0], change = _effect(value, state[0])
                state[1] += change
                state[3].append(value + "}" if ends else value)
                if ends and not state[0]:
                    state[1] -= 1
                    if state[1] <= 1:
                        rows.append((file, name, start, state[2], 0 if state[2] else 1, "".join(state[3])))
                        state[2], state[3] = state[2] + 1, []
            if last:
                if state[3]:
                    rows.append((file, name, start, state[2], 2, "".join(state[3])))
                state = None
            if rows:
                types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "name", "start", "place", "kind", "text"])

    return known.mapInArrow(run, _PART)


def _records(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    """(file, name, start, place, text, record): records in order; the text after the last has no record."""
    pieces = _pieces(spark, path, pattern)
    parts = _parts(pieces, _begins(_effects(pieces)))
    whole = parts.where("kind = 0").select("file", "name", "start", "place", "text", F.lit(True).alias("record"))
    # At most two for each split.
    order = Window.partitionBy("file").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, -1)
    cut = parts.where("kind > 0").withColumn("number", F.coalesce(F.sum(F.when(F.col("kind") == 1, 1).otherwise(0)).over(order), F.lit(0)))
    texts = F.sort_array(F.collect_list(F.struct("start", "place", "text")))
    joined = cut.groupBy("file", "name", "number").agg(
        F.max(F.struct("start", "place")).alias("end"),
        F.array_join(F.transform(texts, lambda t: t["text"]), "").alias("text"),
        (F.max(F.when(F.col("kind") == 1, 1).otherwise(0)) == 1).alias("record"),
    )
    return whole.unionByName(joined.select("file", "name", "end.start", "end.place", "text", "record"))


def _parsed(spark: SparkSession, path: str | list[str], record: T.StructType, pattern: str) -> DataFrame:
    """(file, name, start, place, r, fault): every record, and what is wrong with it or what follows."""
    found = _records(spark, path, pattern)
    body = F.regexp_extract("text", r"(?s)^[\s,\[]*(\{.*)$", 1)
    before = F.substring(F.col("text"), F.lit(1), F.char_length("text") - F.char_length(body))
    # The opening bracket stands before the first record only.
    heads = found.where("record").groupBy("file").agg(F.min(F.struct("start", "place")).alias("head"))
    known = found.join(heads, "file", "left").withColumn("first", F.struct("start", "place") == F.col("head"))
    opened = before.rlike(rf"^[{_SPACE}]*\[[{_SPACE}]*$")
    between = before.rlike(rf"^[{_SPACE}]*,[{_SPACE}]*$")
    r = F.from_json(body, record)
    sound = F.try_parse_json(body).isNotNull() & r.isNotNull() & F.when(F.col("first"), opened).otherwise(between)
    # After the last record: nothing, a comma or the bracket; without records a bracket must open.
    rest = F.when(F.col("head").isNull(), F.col("text").rlike(rf"^[{_SPACE}]*\[[{_SPACE}]*,?[{_SPACE}]*\]?[{_SPACE}]*$")).otherwise(
        F.col("text").rlike(rf"^[{_SPACE}]*(,?|\])[{_SPACE}]*$")
    )
    fault = F.when(F.col("record") & ~F.coalesce(sound, F.lit(False)), "unreadable records").when(
        ~F.col("record") & ~rest, "no JSON array"
    )
    return known.select("file", "name", "start", "place", F.when(F.col("record"), r).alias("r"), fault.alias("fault"))


def read_judge_split(
    spark: SparkSession, path: str | list[str], record: T.StructType = JUDGE_RECORD, pattern: str = "*.json"
) -> DataFrame:
    """The record's columns plus ``file`` and ``pos``, as ``read_judge`` gives them.

    ``pos`` counts from 0 in each file. Anything after the closing bracket is damage here, which
    the whole-file reader passes over; else both refuse the same files. A damaged file is an error that names it, as soon
    as its damage is met; ``judge_rejects_split`` lists all such files.
    """
    rows = _parsed(spark, path, record, pattern)
    fault = F.raise_error(F.concat_ws(": ", F.lit("damaged judge file"), "name", "fault"))
    rows = rows.withColumn("r", F.when(F.col("fault").isNull(), F.col("r")).otherwise(fault)).where("r IS NOT NULL")
    counts = rows.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least"))
    # One row for each split.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "start", "least", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    placed = rows.join(offsets, ["file", "start"])
    pos = (F.col("earlier") + F.col("place") - F.col("least")).alias("pos")
    return placed.select(F.col("name").alias("file"), pos, "r.*")


def judge_rejects_split(
    spark: SparkSession, path: str | list[str], record: T.StructType = JUDGE_RECORD, pattern: str = "*.json"
) -> DataFrame:
    """(file, reason) of the files that ``read_judge_split`` refuses."""
    bad = _parsed(spark, path, record, pattern).where("fault IS NOT NULL")
    return bad.groupBy("file", F.col("name")).agg(F.max("fault").alias("reason")).select(F.col("name").alias("file"), "reason")
