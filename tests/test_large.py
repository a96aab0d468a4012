"""Operators that split what one task used to hold: pairs, quantiles, packs, CSV records."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import allpairs, packing, quantiles
from gradus.sources.files import read_questions_csv
from gradus.sources.split_csv import csv_records, read_csv_split


def _vectors(spark, rows: dict[int, dict[int, float]], copies: dict[int, int]):
    """rows: id to term weights, normalised here; copies: id to the id it copies."""
    made = []
    for i, terms in (rows | {c: rows[o] for c, o in copies.items()}).items():
        norm = sum(w * w for w in terms.values()) ** 0.5
        idx = sorted(terms)
        made.append(("s", i, idx, [terms[t] / norm for t in idx]))
    made.append(("s", 10_000, [], []))
    schema = "source string, id long, idx array<int>, w array<double>"
    return spark.createDataFrame(made, schema).repartition(5)


def _cosines(rows: dict[int, dict[int, float]], threshold: float) -> dict:
    found = {}
    for a in rows:
        for b in rows:
            if a < b:
                dot = sum(w * rows[b].get(t, 0.0) for t, w in rows[a].items())
                norms = [sum(w * w for w in rows[x].values()) ** 0.5 for x in (a, b)]
                cosine = round(dot / (norms[0] * norms[1]), 6)
                if cosine >= threshold:
                    found[(a, b)] = cosine
    return found


@pytest.mark.parametrize("part", [3, 2048])
def test_all_pairs_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(allpairs, "PART", part)
    rng = random.Random(4)
    rows = {}
    for i in range(60):
        base = rows[rng.randrange(i)] if i and rng.random() < 0.6 else {rng.randrange(30): rng.random() for _ in range(8)}
        rows[i] = {t: w * rng.uniform(0.7, 1.3) for t, w in base.items()} | {0: 0.5}  # term 0: in every row
    copies = {100 + i: 7 for i in range(80)}  # one vector more often than all others together
    members = allpairs.vector_classes(_vectors(spark, rows, copies))
    classes = {r.id: r.class_id for r in members.collect()}
    assert classes == {i: i for i in rows} | copies
    for threshold in (0.95, 0.8):
        got = {(r.id, r.other_id): r.cosine for r in allpairs.alike_pairs(members, threshold).collect()}
        wanted = _cosines(rows, threshold)
        assert wanted and got.keys() == wanted.keys()
        assert all(abs(got[k] - wanted[k]) <= 2e-6 for k in got)
    assert allpairs.alike_pairs(members.where("false")).count() == 0


@pytest.mark.parametrize(("entries", "least"), [(30, 4), (8_000_000, 1), (8_000_000, 4)])
def test_pairs_meet_in_blocks_of_bounded_size(spark, monkeypatch, entries, least):
    """Every two blocks meet once, whatever their number; the task holds one of them."""
    for name, value in {"BLOCK_ENTRIES": entries, "LEAST_BLOCKS": least, "BOUNDS": 100}.items():
        monkeypatch.setattr(allpairs, name, value)
    rng = random.Random(5)
    rows = {i: {rng.randrange(300): rng.uniform(0.1, 1.0) for _ in range(5)} | {0: 3.0} for i in range(70)}
    members = allpairs.vector_classes(_vectors(spark, rows, {}))
    items = members.select(F.col("id").alias("item"), "idx", "w")
    blocks = allpairs._blocks(len(rows), sum(map(len, rows.values())))
    held = allpairs._tiles(items, blocks).where("NOT streamed").groupBy("tile").agg(F.sum(F.size("idx")).alias("n")).collect()
    assert (len(held) > 4) == (entries == 30) and max(r.n for r in held) < 10 * entries
    got = [(r.id, r.other_id) for r in allpairs.alike_pairs(members, 0.9).collect()]
    assert len(got) == len(set(got)) and set(got) == _cosines(rows, 0.9).keys()


def test_class_names_equal_the_classes_of_vectors(spark):
    rows = {1: {0: 1.0, 3: 2.0}, 2: {0: 2.0, 3: 1.0}, 3: {1: 1.0}, 4: {0: 1.0, 4: 2.0}, 5: {0: 1.0, 3: 2.0000001}}
    vectors = _vectors(spark, rows, {20: 1, 21: 3, 22: 1})
    wanted = {(r.id, r.class_id) for r in allpairs.vector_classes(vectors).collect()}
    assert wanted == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (20, 1), (21, 3), (22, 1)}
    plan = allpairs.class_names(vectors)
    assert {(r.id, r.class_id) for r in plan.collect()} == wanted
    # What moves is keys: the vectors are behind the table of keys.
    assert "idx" not in plan._jdf.queryExecution().executedPlan().toString()


def test_quantiles_by_selection(spark):
    rng = random.Random(2)
    rows = [("hot", float(rng.randrange(50))) for _ in range(600)] + [("one", 3.5), ("none", None), (None, 1.0), (None, 2.0)]
    rows += [("wide", rng.uniform(-9, 9)) for _ in range(301)] + [("nan", float("nan")), ("nan", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    shares = (0.0, 0.1, 0.5, 0.875, 1.0)
    got = {r.g: (r.n, r.q) for r in quantiles.quantiles(df, "v", shares, ["g"]).collect()}
    assert set(got) == {"hot", "one", None, "wide", "nan"}
    for g, (n, q) in got.items():
        values = [v for h, v in rows if h == g and v is not None and v == v]
        assert n == len(values) and np.allclose(q, np.quantile(values, shares))
    assert quantiles.quantiles(df.where("false"), "v").count() == 0
    alone = quantiles.quantiles(df.where("g = 'wide'"), "v").first()
    assert np.allclose(alone.q, np.quantile([v for g, v in rows if g == "wide"], quantiles.QUARTILES))


def _packed(sizes: list[tuple], budget: int, pack_size: int) -> list[tuple]:
    packs: list[list[tuple]] = []
    for item in sizes:
        if packs and len(packs[-1]) < pack_size and sum(s for _, s in packs[-1]) + item[1] <= budget:
            packs[-1].append(item)
        else:
            packs.append([item])
    return [(i, len(p), p[0][0], p[-1][0], sum(s for _, s in p)) for i, p in enumerate(packs)]


@pytest.mark.parametrize(("budget", "pack_size"), [(0, 5), (40, 4), (100, 10), (10**9, 7), (10**9, 1)])
@pytest.mark.parametrize("parts", ["1", "9", "60"])
def test_packs_by_size(spark, budget, pack_size, parts):
    rng = random.Random(budget + pack_size)
    rows = [(i * 3, "x" * rng.choice([0, 1, 5, 30, 60])) for i in range(150)]
    rows += [(10**15, "far"), (10**15 + 1, None)]  # an outlier stretches nothing
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, "id long, text string").repartition(6)
        got = packing.pack_by_size(df, budget, pack_size).orderBy("pack").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [tuple(r)[:5] for r in got] == _packed([(i, len(t or "")) for i, t in rows], budget, pack_size)
    assert sum(r.n for r in got) == len(rows)
    assert got[0].body.startswith("Item 1:\n")


def test_packs_of_equal_and_null_keys(spark):
    rows = [(5, "ab")] * 40 + [(None, "abc")] * 3
    df = spark.createDataFrame(rows, "id long, text string")
    got = packing.pack_by_size(df, 10, 10).orderBy("pack").collect()
    assert [r.n for r in got] == [5 if i else 3 for i in range(9)][: len(got)] or sum(r.n for r in got) == 43
    assert all(r.n_chars <= 10 for r in got) and got[0].first_id is None
    assert packing.pack_by_size(df.where("false"), 10).count() == 0


def test_csv_in_splits_equals_the_whole_reader(spark, tmp_path):
    rng = random.Random(8)
    schema = "id long, text string, source string"
    rows = []
    for i in range(400):
        text = "".join(rng.choice(['a', 'é', ' b', '"', ',', '\n', '\n\n', '""']) for _ in range(rng.randint(1, 60)))
        rows.append((i, f"x{text}x", rng.choice(["s", "s,1", 'q"', None])))
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "csv")
    df.coalesce(2).write.csv(path, header=True, escape='"')
    wanted = sorted(tuple(r) for r in read_questions_csv(spark, path, df.schema).collect())
    assert wanted == sorted(tuple(r) for r in df.collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("64", "1000", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        try:
            assert size == "1m" or spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 4
            got = read_csv_split(spark, path, df.schema)
            assert sorted((tuple(r) for r in got.collect())) == wanted
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_line_ends_and_open_quotes(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_bytes(b'id,text\r\n1,"a\r\nb"\r\n\r\n2,plain\r\n3,""\r\n4,"never closed\n5,x\n')
    spark_rows = read_csv_split(spark, str(file), spark.createDataFrame([], "id long, text string").schema)
    got = {r.id: r.text for r in spark_rows.collect()}
    assert got[1] == "a\r\nb" and got[2] == "plain" and 5 not in got
    assert csv_records(spark, str(file)).where(F.col("first")).count() == 1


def test_blocks_are_not_shuffled_past_each_other(spark, monkeypatch):
    """Every vector was shuffled to half of the blocks: what lay on disk grew with the square of the rows."""
    monkeypatch.setattr(allpairs, "PART", 10)
    rng = random.Random(6)
    rows = {i: {rng.randrange(40): rng.uniform(0.1, 1.0) for _ in range(5)} | {0: 3.0} for i in range(90)}
    members = allpairs.vector_classes(_vectors(spark, rows, {200: 3, 201: 3}))
    stored, durable = [], allpairs.durable
    monkeypatch.setattr(allpairs, "durable", lambda df: stored.append((df, durable(df))) or stored[-1][1])
    wanted = _cosines(rows, 0.9)
    got = [(r.id, r.other_id) for r in allpairs.alike_pairs(members, 0.9).collect()]
    assert wanted and len(got) == len(set(got)) and set(got) == wanted.keys()
    waves = [(df, table) for df, table in stored if "other" in df.columns]
    assert len(waves) == 3  # nine blocks, four at a time
    assert all("Exchange" not in df._jdf.queryExecution().executedPlan().toString() for df, _ in waves)
    # No vector is stored more than once.
    assert sum(table.count() for _, table in stored if "idx" in table.columns) == len(rows)
