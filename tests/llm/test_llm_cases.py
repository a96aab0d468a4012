"""Columns of the caller by any name, NULL turns, spans in order, pages under any name."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradus.llm import chat, html_extraction, pii, url_filter, wu_manber


def _with(df, names: str):
    return df.withColumns({name: F.lit(f"own {name}") for name in names.split()})


def test_url_filter_keeps_columns_of_any_name(spark):
    urls = [("http://a.com/x",), ("http://b.net/y/",), (None,), ("http://b.net/" + "z" * 100_000,)]
    names = "w0 w7 block key listed _listed maybe row h.x"
    df = _with(spark.createDataFrame(urls, "url string"), names)
    listed = spark.createDataFrame([("b.net/y",), (None,)], "listed string")
    got = url_filter.judge(df, [url_filter.Rule("allow", "com")], listed)
    assert got.columns == [*df.columns, "host", "path", "rule", "verdict"]
    rows = {r.url: r for r in got.collect()}
    assert [rows[u[0]].verdict for u in urls] == ["allow", "block", "allow", "allow"]
    assert all(rows[u[0]][n] == f"own {n}" for u in urls for n in names.split())
    assert got.where("false").count() == 0


def test_decontamination_keeps_columns_of_any_name(spark, monkeypatch):
    names = "n0 s0 i0 _n _spans _items row body"
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:40]), " ".join(words[100:130]), None, "", "w5"]
    df = _with(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), names)
    items = [(i, " ".join(words[i * 10 : i * 10 + 13])) for i in range(12)] + [(50, None), (None, "w5")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = []
    for size in (50, 1_000_000):  # several blocks, one block
        monkeypatch.setattr(wu_manber, "BLOCK_WORDS", size)
        found = wu_manber.decontaminate(df, bench)
        assert found.columns == [*df.columns, "n_words", "n_hit", "hit_spans", "items", "contaminated"]
        rows = sorted(found.collect())
        assert all(r[n] == f"own {n}" for r in rows for n in names.split())
        got.append([(r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in rows])
    assert got[0] == got[1]
    assert got[0][0] == (0, 40, 33, ["", "0", "1", "2"], True) and got[0][4][2:] == (1, [""], True)
    assert got[0][2] == (2, 0, 0, [], False)


def test_null_turns_stay(spark):
    turns = [(1, 1, "user", "hi"), (1, 2, "assistant", None), (1, 3, None, "x"), (1, 4, "assistant", "yes")]
    made = chat.render(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    row = made.withColumn("turns", chat.parse(F.col("formatted"))).first()
    assert [(t.role, t.text) for t in row.turns] == [("user", "hi"), ("assistant", ""), ("", "x"), ("assistant", "yes")]
    assert [row.formatted[s.start : s.end] for s in row.loss_spans] == ["", "yes"]


def test_many_spans_take_no_more_than_their_number(spark):
    text = "jane at mail dot org, " + "a@b.cd " * 20_000
    base, every = pii.all_spans(text)
    assert len(base["email"]) == 20_000 and len(every["email"]) == 20_001
    assert every["email"] == sorted(every["email"])
    df = _with(spark.createDataFrame([("see a@b.cd",), (None,)], "text string"), "_redacted _redacted_")
    got = pii.redact(df).collect()
    assert [r.text for r in got] == ["see <email>", None] and got[0]["_redacted"] == "own _redacted"


def test_pages_under_any_name(spark):
    page = "<html><body><article><p>One two three.</p></article></body></html>"
    df = spark.createDataFrame([(1, page), (1, page), (2, None), (3, "")], "n_chars long, text string")
    got = html_extraction.extract(df.withColumn("_page", F.lit("own")), "text")
    assert got.columns == ["_page", "text", "n_chars"]
    assert sorted(tuple(r) for r in got.collect()) == [("own", "", 0)] * 2 + [("own", "One two three.", 14)] * 2
    assert html_extraction.extract(df.where("false"), "text").count() == 0
