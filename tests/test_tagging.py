from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gradus.operators import tagging
from gradus.streaming.resume import tag_stream

CACHE = "id long, pred string, written timestamp"


@pytest.mark.parametrize(
    ("raw", "value"),
    [
        ('{"v": "a"}', "a"),
        ('```json\n{"v": "a"}\n```', "a"),
        ('well, {"v": "a"} it is', "a"),
        ("no json at all", None),
        ('{"v": ', None),
        ("", None),
        (None, None),
    ],
)
def test_parse_reply(spark, raw, value):
    df = spark.createDataFrame([(raw,)], "raw string")
    parsed = df.select(tagging.parse_reply(F.col("raw"), "struct<v: string>").alias("r"))
    assert parsed.select("r.v").first().v == value


def test_parse_packed_reply(spark):
    raw = 'Here: [{"id": 1, "v": "a"}, {"id": 2, "v": "b"}] ok'
    df = spark.createDataFrame([(raw,)], "raw string")
    schema = "array<struct<id: int, v: string>>"
    rows = df.select(F.inline(tagging.parse_reply(F.col("raw"), schema))).collect()
    assert [(r.id, r.v) for r in rows] == [(1, "a"), (2, "b")]


def test_retry_rules(spark):
    requests = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "pack long, position int")
    replies = spark.createDataFrame(
        [(0, 1, "a", 1), (0, 1, "b", 2), (0, 2, "", 1)],
        "pack long, position int, value string, reply_no int",
    )
    got = {r.position: (r.value, r.retry) for r in tagging.match_replies(requests, replies, "value").collect()}
    assert got == {1: ("b", False), 2: ("", True), 3: (None, True)}
    lax = tagging.match_replies(requests, replies, "value", retry_blank=False)
    assert {r.position for r in lax.where("retry").collect()} == {3}


def test_packs_are_consecutive(spark):
    df = spark.createDataFrame([(i * 3, f"t{i}") for i in range(25)], "id long, text string")
    packs = tagging.pack_requests(df, 10).orderBy("pack").collect()
    assert [(p.n, p.first_id, p.last_id) for p in packs] == [(10, 0, 27), (10, 30, 57), (5, 60, 72)]
    assert packs[2].body.startswith("Item 1:\nt20\n\nItem 2:\nt21")


def test_resume_only_pending_items(spark, tmp_path):
    items = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "id long, text string")
    cache, asked = str(tmp_path / "cache"), []

    def classify(todo):
        asked.append(sorted(r.id for r in todo.collect()))
        return todo.select("id", F.concat(F.lit("p"), "text").alias("pred"))

    first = tagging.classify_with_cache(items.where("id < 4"), cache, classify, CACHE)
    assert first.where("pred is null").count() == 0
    again = tagging.classify_with_cache(items, cache, classify, CACHE)
    assert {r.id: r.pred for r in again.collect()} == {i: f"pt{i}" for i in range(6)}
    tagging.classify_with_cache(items, cache, classify, CACHE)
    assert asked == [[0, 1, 2, 3], [4, 5]]


def test_cache_is_kept_by_source(spark, tmp_path):
    items = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "id long, source string")
    cache = str(tmp_path / "cache")
    schema = "id long, source string, pred string, written timestamp"

    def classify(todo):
        return todo.select("id", "source", F.concat(F.lit("p"), F.coalesce("source", F.lit("-"))).alias("pred"))

    tagging.classify_with_cache(items.where("source = 'a'"), cache, classify, schema)
    got = tagging.classify_with_cache(items, cache, classify, schema).collect()
    assert {(r.id, r.source, r.pred) for r in got} == {(1, "a", "pa"), (1, "b", "pb"), (2, None, "p-")}
    with pytest.raises(ValueError, match="source"):
        tagging.classify_with_cache(
            items, str(tmp_path / "other"), lambda todo: todo.select("id", F.lit("x").alias("pred")), schema
        )


def test_a_key_cached_twice_has_one_value(spark):
    items = spark.createDataFrame([(1, "a"), (2, "a")], "id long, source string")
    cache = spark.createDataFrame(
        [(1, "a", "new", 2), (1, "a", "old", 1), (1, "a", "even", 2), (1, "b", "zz", 3)],
        "id long, source string, pred string, run int",
    )
    assert {r.id: r.pred for r in tagging.align(items, cache, "pred", "run").collect()} == {1: "new", 2: None}


def test_tag_stream_resumes(spark, tmp_path):
    source, cache, state = (str(tmp_path / n) for n in ("in", "cache", "state"))
    schema = spark.createDataFrame([], "id long, text string").schema

    def tag(todo):
        return todo.select("id", F.upper("text").alias("pred"))

    def run():
        query = tag_stream(spark, source, schema, cache, CACHE, state, tag)
        query.awaitTermination(120)
        assert query.exception() is None

    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(source)
    run()
    spark.createDataFrame([(2, "x"), (3, "c")], schema).write.mode("append").parquet(source)
    run()
    rows = spark.read.schema(CACHE).parquet(cache).collect()
    assert {(r.id, r.pred) for r in rows} == {(1, "A"), (2, "B"), (3, "C")} and len(rows) == 3


def test_user_model_hook(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "c")], "id long, text string")

    def model(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": pdf["id"], "n": pdf["text"].str.len()})

    got = tagging.tag_with(df, model, "id long, n long").collect()
    assert {(r.id, r.n) for r in got} == {(1, 2), (2, 1)}


def test_dictionary_as_a_table(spark):
    rows = [(i, "s", ["common", f"w{i}", "deep", "sea"]) for i in range(300)]
    rows += [(300, "s", []), (301, None, ["common", "common"]), (None, "s", ["sea", "deep"]), (302, "s", None)]
    df = spark.createDataFrame(rows, "id long, source string, words array<string>").repartition(5)
    terms = [("common", "c"), ("deep sea", "d"), ("w7", "a"), ("w7", "b"), ("w7", "a"), ("absent", "x"), (None, "n")]
    dictionary = spark.createDataFrame(terms, "word string, concept string")
    got = {r.id: r.concepts for r in tagging.tag_by_dictionary(df, dictionary, ["source", "id"], longest=2).collect()}
    assert len(got) == len(rows)
    assert got[7] == ["a", "b", "c", "d"] and got[8] == ["c", "d"] and got[301] == ["c"]
    assert got[300] == got[302] == got[None] == []
    single = tagging.tag_by_dictionary(df, dictionary, ["source", "id"])
    assert {r.id: r.concepts for r in single.collect()}[8] == ["c"]
    assert tagging.tag_by_dictionary(df, dictionary.where("false"), ["id"]).where("size(concepts) > 0").count() == 0
