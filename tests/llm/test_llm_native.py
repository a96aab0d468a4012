"""URL filter, sharding, fingerprints and chat: SQL on the smallest data, laws, hand cases."""

from __future__ import annotations

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from gradus.llm import chat, order_minhash, sharding, url_filter
from gradus.llm.queries import ORACLES, QUERIES
from tools.check_oracles import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    sql = duckdb.connect()
    for table in TABLES:
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = sql.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    df = QUERIES[name](spark, FOLDER)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_url_cases(spark):
    rows = [(1, "http://A.example.com/en/x?q"), (2, None), (3, "no scheme"), (4, "x://www.example.com/en/"),
            (5, "x://b.org/list/"), (5, "x://b.org/list/"), (6, "x://notexample.net/fr/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("clash"))
    rules = [url_filter.Rule("block", "example.com", "/en/"), url_filter.Rule("allow", "www.example.com", "/en/")]
    listed = spark.createDataFrame([("b.org/list",), (None,), ("b.org/list",)], "u string")
    got = sorted((r.page_id, r.host, r.rule, r.verdict) for r in url_filter.judge(df, rules, listed).collect())
    assert got == sorted([
        (1, "a.example.com", "example.com/en/", "block"), (2, "", None, "allow"), (3, "", None, "allow"),
        (4, "www.example.com", "www.example.com/en/", "allow"), (5, "b.org", None, "block"),
        (5, "b.org", None, "block"), (6, "notexample.net", None, "allow"),
    ], key=lambda x: x[:2])
    assert url_filter.judge(df.limit(0), [], listed.limit(0)).count() == 0


def test_sharding_laws(spark):
    rows = [(i, None if i % 9 == 0 else "é" * (i % 50)) for i in range(2000)] + [(None, "x"), (7, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("clash"))
    got = sharding.shard(df, sharding.even_tree(16)).collect()
    assert len(got) == len(rows)
    by_shard: dict[int, list] = {}
    for r in got:
        assert r.grown_shard in (r.shard, 16)
        by_shard.setdefault(r.shard, []).append(r)
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        ordered = sorted(members, key=lambda r: r.slot)
        assert [r.doc_id or -1 for r in ordered] == sorted(r.doc_id or -1 for r in members)
        assert 60 < len(members) < 190
    assert {r.size for r in got if r.doc_id == 9} == {1}
    assert sharding.shard(df.limit(0), sharding.even_tree(2)).count() == 0


def test_weight_change_stays_in_subtree(spark):
    tree = [sharding.Shard("a", "r", 0), sharding.Shard("a", "s", 1), sharding.Shard("b", "t", 2), sharding.Shard("b", "t", 3)]
    heavier = [*tree[:3], sharding.Shard("b", "t", 3, 2.0)]
    df = sharding.place(sharding.place(spark.range(3000), F.col("id"), tree, "x"), F.col("id"), heavier, "y")
    moved = {(r.x, r.y) for r in df.where("x <> y").select("x", "y").collect()}
    # Rows enter region b, or go to the heavier shard inside it; none leaves it.
    assert moved and all(x in (0, 1) and y in (2, 3) or (x, y) == (2, 3) for x, y in moved)


def test_fingerprints(spark):
    texts = ["", None, "one", "a b c d e f g h", "a b c d e f g h", "x " * 5000, " \n", "é ü ß ñ" * 9]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, "a b c d e f g h")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1))
    got = {r.doc_id: r for r in order_minhash.edited_pairs(df).collect()}
    assert len(got) == len(rows)
    plain = [t or "" for t in texts]
    for i, text in enumerate(plain):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + plain[(i + 1) % len(plain)][:cut]
        assert got[i * 3].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i * 3].near_edited <= 1
    assert got[9].fingerprint == got[12].fingerprint == got[None].fingerprint
    assert got[9].near_next == 1.0 and got[0].near_next == 1.0 and got[None].near_next is None
    assert order_minhash.edited_pairs(df.limit(0)).count() == 0


def test_fingerprint_sees_order(spark):
    words = [f"w{i}" for i in range(300)]
    moved = words[150:] + words[:150]
    df = spark.createDataFrame([(" ".join(words), " ".join(moved), " ".join(words[:290]))], "a string, b string, c string")
    prints = df.select(*[order_minhash.fingerprint(F.col(c)).alias(c) for c in "abc"])
    r = prints.select(order_minhash.likeness(F.col("a"), F.col("b")).alias("ab"), order_minhash.likeness(F.col("a"), F.col("c")).alias("ac")).first()
    assert r.ab < 0.75 < r.ac


def test_chat_fold_and_escape(spark):
    log = [
        (1, 1, 1, "message", "user", "hel"), (1, 2, 1, "delta", None, "lo"),
        (1, 3, 2, "message", "assistant", "draft"), (1, 4, 2, "regenerate", None, ""),
        (1, 5, 2, "delta", None, "<|end|>\\ fine"), (1, 6, 3, "message", "user", "gone"),
        (1, 7, 2, "edit", None, "kept <|turn|>"), (2, 1, 1, "message", None, None),
    ]
    df = spark.createDataFrame(log, "conv_id long, seq long, turn long, kind string, role string, text string")
    made = chat.render(chat.fold_events(df))
    got = {r.conv_id: r for r in made.select(
        "conv_id", chat.parse(F.col("formatted")).alias("turns"),
        chat.trained_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "hello"), ("assistant", "kept <|turn|>")]
    assert got[1].loss == "kept <|turn|>"
    assert [tuple(t) for t in got[2].turns] == [("", "")] and got[2].loss == ""
    assert chat.render(chat.fold_events(df.limit(0))).count() == 0
