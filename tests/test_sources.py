from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from gradus.plans.consolidation import clean_corpus, from_judge, from_ratings
from gradus.schema import LEVELS_5, QUESTIONS
from gradus.sources import files, split_json, tables


def test_csv_with_newlines_and_quotes(spark, tmp_path):
    path = tmp_path / "questions.csv"
    path.write_text(
        'id,text,n_ratings,mean_rating,mode_rating,label\n7,"two\nlines, ""quoted""",0,,,\n8,x,1,2.0,2,facil\n'
    )
    rows = files.read_questions_csv(spark, str(path)).orderBy("id").collect()
    assert rows[0].text == 'two\nlines, "quoted"' and rows[0].label is None
    assert rows[1].mode_rating == 2
    assert files.read_questions_csv(spark, str(path)).schema == QUESTIONS


def test_json_array(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text(json.dumps([{"id": 1, "text": "a"}, {"id": 2}]))
    rows = files.read_json_array(spark, str(path), QUESTIONS).orderBy("id").collect()
    assert [(r.id, r.text) for r in rows] == [(1, "a"), (2, None)]


def test_statements_and_ratings_layout(spark, tmp_path):
    folder = tmp_path / "txt"
    folder.mkdir()
    (folder / "exercise_1.txt").write_text("\n one \n two\n")
    (folder / "exercise_2.txt").write_bytes("á".encode() + b"\xff b")
    (folder / "exercise_x.txt").write_text("no id")
    (folder / "._exercise_3.txt").write_text("junk")
    (folder / "readme.md").write_text("no")
    (tmp_path / "feedbacks_2024.json").write_text(
        json.dumps([{"question_id": 1, "difficultylevel": n} for n in (1, 1, 5, 5, 4)])
    )
    ratings = files.read_ratings(spark, str(tmp_path / "feedbacks_*.json"))
    assert {r.batch for r in ratings.collect()} == {"feedbacks_2024"}
    rows = {
        r.id: r
        for r in from_ratings(spark, str(folder), str(tmp_path / "feedbacks_*.json")).collect()
    }
    assert set(rows) == {1, 2}
    assert rows[1].text == "one \n two" and rows[1].mode_rating == 5 and rows[1].label == "medio"
    assert rows[2].text == "á b" and rows[2].n_ratings == 0 and rows[2].label is None


def judge_record(number, difficulty, text="t"):
    return {
        "ID": number,
        "Problem_Description": text,
        "Test_Case": [{"input": "1", "output": "2"}],
        "metadata": {"Difficulty": difficulty},
    }


def test_judge_layout_damaged_array_first_row_wins(spark, tmp_path):
    records = [
        judge_record(2, "Fácil", "first"),
        judge_record(2, "Difícil", "second"),
        judge_record(None, "Fácil"),
        judge_record(1, " "),
    ]
    body = json.dumps(records, ensure_ascii=False)[:-1] + ",\n"
    (tmp_path / "judge.json").write_text(body)
    (tmp_path / "feedbacks_1.json").write_text("[]")
    rows = {r.id: r for r in from_judge(spark, str(tmp_path)).collect()}
    assert set(rows) == {1, 2}
    assert rows[2].text.startswith("first") and rows[2].label == "facil" and rows[2].n_ratings == 1
    assert rows[2].mean_rating == 2.0 and rows[1].label is None and rows[1].n_ratings == 0
    plain = {r.id: r.text for r in from_judge(spark, str(tmp_path), with_examples=False).collect()}
    assert plain[2] == "first"


@pytest.mark.parametrize(
    ("body", "reason"),
    [
        ("not json at all", "no JSON array"),
        ('[{"ID": 1}, oops, {"ID": 3}]', "no JSON array"),
        ('[{"ID": 1}, {"ID": 2, "Problem_Desc', "no JSON array"),
        ("\n", "no JSON array"),
        ('{"ID": 1}', "no JSON array"),
    ],
)
def test_damaged_judge_file_is_named(spark, tmp_path, body, reason):
    (tmp_path / "good.json").write_text('[{"ID": 1}, {"ID": 2},')
    (tmp_path / "bad.json").write_text(body)
    rejects = files.judge_rejects(spark, str(tmp_path)).collect()
    assert [(r.file, r.reason) for r in rejects] == [("bad.json", reason)]
    with pytest.raises(Exception, match="damaged judge file: bad.json"):
        files.read_judge(spark, str(tmp_path)).collect()
    rows = files.read_judge(spark, str(tmp_path / "good.json")).collect()
    assert [(r.pos, r.ID) for r in rows] == [(0, 1), (1, 2)]


def test_judge_lines_keep_file_order_across_splits(spark, tmp_path):
    path = tmp_path / "judge.jsonl"
    path.write_text("".join(json.dumps(judge_record(n, "Fácil", "x" * (n % 70))) + "\n" for n in range(400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = files.read_judge_lines(spark, str(path))
        assert lines.select("pos.part").distinct().count() > 3
        assert [r.ID for r in lines.orderBy("file", "pos").collect()] == list(range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    ("raw", "n"),
    [('[{"k": 1}]', 1), ('[{"k": 1},', 1), ('[{"k": 1}, {"k": 2}', 2), ("[]", 0)],
)
def test_parse_json_array(spark, raw, n):
    from pyspark.sql import types as T

    element = T.StructType([T.StructField("k", T.LongType())])
    df = spark.createDataFrame([(raw,)], "raw string")
    assert len(df.select(files.parse_json_array(F.col("raw"), element).alias("a")).first().a) == n


def test_catalog_union_and_partitioned_sink(spark, tmp_path):
    labelled = spark.createDataFrame([(1, "a", "facil"), (2, "b", None)], "id long, text string, label string")
    bare = spark.createDataFrame([(1, "c")], "id long, text string")
    union = tables.catalog_union({"x": labelled, "y": bare})
    assert union.where("label is null").count() == 2
    root = str(tmp_path / "catalog")
    tables.write_catalog(union, root, files_per_source=2)
    assert tables.read_catalog(spark, root, ["y"]).count() == 1
    with pytest.raises(FileNotFoundError):
        tables.read_catalog(spark, root, ["z"])
    with pytest.raises(KeyError):
        tables.catalog_union({"x": bare.drop("text")})


def test_contract(spark):
    rows = spark.createDataFrame(
        [(1, "a", "facil"), (1, " ", "nope"), (None, None, None), (2, "b", None)],
        "id long, text string, label string",
    )
    report = tables.contract_report(rows, ["id"], "text", "label", LEVELS_5).first().asDict()
    assert report == {
        "rows": 4, "null_keys": 1, "duplicate_keys": 1, "null_text": 1, "blank_text": 1, "odd_labels": 1,
    }
    with pytest.raises(ValueError, match="duplicate_keys"):
        tables.check_contract(rows, label="label", scale=LEVELS_5)
    fine = rows.where("id = 2")
    assert tables.check_contract(fine, label="label", scale=LEVELS_5).count() == 1


def test_clean_corpus(spark):
    rows = spark.createDataFrame(
        [(1, "Árvore B", " Facil "), (2, "! ?", "x"), (3, None, "x"), (4, "grafo", "nan")],
        "id long, text string, label string",
    )
    got = {r.id: (r.label, r.clean) for r in clean_corpus(rows).collect()}
    assert got == {1: ("facil", "arvore"), 4: (None, "grafo")}


def test_labelled_rows_or_an_error(spark):
    rows = spark.createDataFrame([(1, "facil")], "id long, label string")
    assert tables.labelled_only(rows).count() == 1
    with pytest.raises(ValueError, match="unlabelled"):
        tables.labelled_only(rows, wanted=False)


def test_judge_lines(spark, tmp_path):
    path = tmp_path / "judge.jsonl"
    path.write_text("\n".join(json.dumps(judge_record(n, "Fácil", t)) for n, t in [(1, "a"), (1, "b")]))
    from gradus.operators.ratings import judge_questions

    rows = judge_questions(files.read_judge_lines(spark, str(path)), False).collect()
    assert [(r.id, r.text) for r in rows] == [(1, "a")]


def test_cache_and_report_sinks(spark, tmp_path):
    cache, report = str(tmp_path / "cache"), str(tmp_path / "report")
    assert tables.read_cache(spark, cache, "id long, pred string").count() == 0
    rows = spark.createDataFrame([(1, "facil")], "id long, pred string")
    tables.publish(rows, cache)
    tables.publish(rows, cache)
    assert tables.read_cache(spark, cache, "id long, pred string").count() == 2
    tables.write_report(rows, report)
    assert spark.read.parquet(report).count() == 1


def test_consolidated_metrics(spark):
    from gradus.operators import consolidate

    table = spark.createDataFrame([("knn", 0.4), ("svm", 0.5)], "model string, f1_macro double")
    whole = consolidate.gather({("x", 3): table, ("y", 5): table.where("model = 'knn'")})
    best = {(r.source, r.n_levels): r.model for r in consolidate.best(whole).collect()}
    assert best == {("x", 3): "svm", ("y", 5): "knn"}


def test_last_statement_file_of_an_id_counts(spark, tmp_path):
    for name, text in {"exercise_1.txt": "late", "exercise_01.txt": "early", "Exercise_7.txt": "x", "exercise_2.txt": " two\n"}.items():
        (tmp_path / name).write_text(text)
    got = {r.id: r.text for r in files.read_statements(spark, str(tmp_path)).collect()}
    assert got == {1: "late", 2: "two"}


def _arrays(rng):
    """JSON arrays of judge records, some cut off, with braces, quotes and brackets in strings."""
    def record(n):
        text = "".join(rng.choice(['a', '}', '{', '[', ']', '"', '\\', ',', '\n', 'é', ' ']) for _ in range(rng.randint(0, 40)))
        made = judge_record(n, rng.choice(["Fácil", "", "}"]), text)
        made["Test_Case"] = [{"input": "{" * rng.randint(0, 3), "output": "]\\"}] * rng.randint(0, 3)
        return made

    for n in (0, 1, 2, 40):
        records = [record(i) for i in range(n)]
        whole = json.dumps(records, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))
        for text in (whole, whole + " \n", whole.rstrip("]"), whole.rstrip("]\n ") + ",", whole.rstrip("]\n ") + ",\n\n", f" \n{whole}"):
            yield text


def _damaged(rng):
    yield from ('[{"ID": 1}, {"ID": 2', '{"ID": 1}', "nothing", '[{"ID": 1} {"ID": 2}]', '[{"ID": 1}, 5]', '[{"ID": 1}]]', '[{"ID": "x]', '["a"]', '[{"ID" 1}]')


@pytest.mark.parametrize("size", ["1500", "8m"])
def test_judge_arrays_in_splits_equal_the_whole_reader(spark, tmp_path, size):
    rng = random.Random(5)
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir()
    bad.mkdir()
    for folder, texts in ((good, _arrays(rng)), (bad, _damaged(rng))):
        for i, text in enumerate(texts):
            (folder / f"f{i:02d}.json").write_text(text)
    (good / "feedbacks_1.json").write_text("not read")
    (good / "empty.json").write_text("")
    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "5"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        wanted = files.read_judge(spark, str(good)).orderBy("file", "pos").collect()
        got = split_json.read_judge_split(spark, str(good))
        assert got.columns == files.read_judge(spark, str(good)).columns
        assert got.orderBy("file", "pos").collect() == wanted and len(wanted) > 200
        assert split_json.judge_rejects_split(spark, str(good)).count() == 0
        refused = {r.file for r in split_json.judge_rejects_split(spark, str(bad)).collect()}
        # The whole-file reader passes over what follows the closing bracket (f05).
        assert refused - {"f05.json"} == {r.file for r in files.judge_rejects(spark, str(bad)).collect()}
        assert "f05.json" in refused and len(refused) > 7
        with pytest.raises(Exception, match="damaged judge file: f0"):
            split_json.read_judge_split(spark, str(bad)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
