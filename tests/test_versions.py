"""The cache as a table of versions: whole batches, compaction, joins that leave it where it is."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradus.sources.versions import CacheTable

SCHEMA = "source string, id long, pred string"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_versions_pending_and_compaction(spark, tmp_path):
    path = str(tmp_path / "cache")
    cache = CacheTable(spark, path, SCHEMA, buckets=4)
    items = spark.createDataFrame([("1", "a"), ("2", "a"), ("1", "b"), ("9", "b"), (None, "b")], "id string, source string")
    assert cache.read().count() == 0 and cache.pending(items).count() == 5
    assert cache.publish(_rows(spark, ("a", 1, "x"), ("b", 1, "y"), ("a", 1, "w"))) == 0
    assert cache.publish(_rows(spark, ("a", 1, "v"), ("a", 2, None))) == 1
    # Another session's reader sees the same; ids repeat between sources.
    other = CacheTable(spark, path, SCHEMA, buckets=4)
    wanted = {(1, "a"): "v", (2, "a"): None, (1, "b"): "y", (9, "b"): None, (None, "b"): None}
    for reader in (cache, other):
        assert {(r.id, r.source): r.pred for r in reader.align(items, "pred").collect()} == wanted
        assert sorted(r.id for r in reader.pending(items).where("id IS NOT NULL").collect()) == [9]
    before = other.read().count()
    assert cache.compact("pred") == 2
    assert before == 5 and cache.read().count() == 3 and other.read().count() == 3
    assert {(r.id, r.source): r.pred for r in other.align(items, "pred").collect()} == wanted
    assert cache.publish(_rows(spark, ("b", 9, "z"))) == 3
    assert other.pending(items.where("id IS NOT NULL")).count() == 0


def test_a_killed_batch_leaves_no_trace(spark, tmp_path):
    cache = CacheTable(spark, str(tmp_path / "cache"), SCHEMA, buckets=4)
    cache.publish(_rows(spark, ("a", 1, "x")))

    def broken(todo):
        return todo.withColumn("pred", F.when(F.col("id") == 3, F.raise_error(F.lit("killed"))).otherwise("p"))

    items = spark.createDataFrame([(i, "a") for i in range(1, 6)], "id long, source string").repartition(5)
    with pytest.raises(Exception, match="killed"):
        cache.resume(items, broken, "pred").collect()
    again = CacheTable(spark, str(tmp_path / "cache"), SCHEMA, buckets=4)
    assert [tuple(r)[:3] for r in again.read().collect()] == [("a", 1, "x")]
    asked = []

    def answer(todo):
        asked.extend(r.id for r in todo.collect())
        return todo.withColumn("pred", F.lit("p"))

    got = {r.id: r.pred for r in again.resume(items, answer, "pred").collect()}
    assert got == {1: "x", 2: "p", 3: "p", 4: "p", 5: "p"} and sorted(asked) == [2, 3, 4, 5]
    assert again.resume(items, answer, "pred").count() == 5 and len(asked) == 4


def test_the_cache_is_not_shuffled(spark, tmp_path):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        place = F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("source")
        cache = CacheTable(spark, str(tmp_path / "cache"), SCHEMA, buckets=8)
        cache.publish(spark.range(500).select(place, "id", F.lit("x").alias("pred")))
        cache.publish(spark.range(300).select(place, "id", F.lit("y").alias("pred")))
        items = spark.range(600).select("id", place)
        for found in (cache.align(items, "pred"), cache.pending(items)):
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        got = cache.align(items, "pred").groupBy("pred").count().collect()
        assert {r.pred: r["count"] for r in got} == {"y": 300, "x": 200, None: 100}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
