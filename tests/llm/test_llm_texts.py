"""Near-dedup, tokens, pages, toxicity, decontamination and personal data against brute force."""

from __future__ import annotations

import base64
import random
import re
from array import array

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from gradus.llm import bpe, html_extraction, pii, superminhash, toxicity, wu_manber
from gradus.llm.queries import QUERIES, TOKENIZER
from gradus.llm.shingles import overlap, shingle_sets

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(TOKENIZER)


def _groups(texts: dict, width: int) -> dict:
    sets = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = QUERIES["op1_minhash_near_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == _groups(texts, 2)


def test_near_duplicate_cases(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:i] + ["x"] + base[i + 1 :])) for i in range(40)]
    rows += [(100, None), (101, ""), (102, " \t"), (103, "one"), (104, "ONE"), (None, "one"), (103, "one"), (105, "y " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash"))
    got = superminhash.near_duplicates(df, shingle_words=2).collect()
    assert len(got) == len(rows)
    wanted = _groups({i: t for i, t in rows if i is not None}, 2)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == wanted[r.doc_id]
    left = superminhash.keep_one(df, shingle_words=2)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {i for i, w in wanted.items() if w[2]} | {None}
    assert superminhash.near_duplicates(df.limit(0)).count() == 0


def test_superminhash_estimates():
    rng = np.random.default_rng(3)
    for size, share in ((20, 0.5), (300, 0.8), (3000, 0.3)):
        pool = np.unique(rng.integers(0, 1 << 62, 2 * size).astype(np.uint64))
        common = int(size * share)
        a, b = np.sort(pool[:size]), np.sort(np.concatenate([pool[:common], pool[size : 2 * size - common]]))
        s = superminhash.signatures([a, b, np.empty(0, np.uint64)])
        both = overlap(a, b)
        assert abs((s[0] == s[1]).mean() - both / (len(a) + len(b) - both)) < 0.15
        assert (s[2] == s[2].max()).all() and s[0].max() < s[2].max()
    assert [len(x) for x in shingle_sets([b"a b a b a", b"", b"one"], 2)] == [2, 0, 1]


@pytest.fixture(scope="module")
def known():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(known):
    own = bpe.codec(PATH, public_tokenizers.PATTERN)
    rng = random.Random(5)
    pool = [chr(i) for i in [*range(0x250), *range(0x3B0, 0x460), *range(0x4E00, 0x4E40), *range(0x1F600, 0x1F640)]]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(rng.choices("aeinrst ", k=200)) for _ in range(300)]
    texts += ["a" * 3000, " " * 3000, "\n \n" * 300, "<|endoftext|>", "x\x1cy\x85z  ", "THE!! " * 500]
    for text in texts:
        ids = array("I", own.encode(text))
        assert ids.tolist() == known.encode_ordinary(text)
        assert "".join(own.decode(ids)) == text
    smiley = known.encode_ordinary("\U0001f642 ok")
    assert "".join(own.decode(smiley[:1])) == known.decode(smiley[:1])


def test_bpe_cases(spark, known):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "é 12"), (3, "é 12")], "doc_id long, text string")
    df = df.withColumn("ids", F.lit("clash"))
    made = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    back = bpe.decode(made, PATH, public_tokenizers.PATTERN).collect()
    assert [(r.doc_id, r.ids, r.decoded) for r in back] == [
        (1, [], ""), (2, [], ""), *[(3, known.encode_ordinary("é 12"), "é 12")] * 2]
    assert bpe.digests(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_html():
    page = """<html><head><title>T</title></head><body><nav><ul><li><a href=x>Home</a></ul></nav>
    <div class="cookie-notice">We use, cookies.</div><div id=content><h2>Head</h2>
    <p>First, a <b>bold</b>\n word. Then &lt;more&gt;.<p>Second; one, two, three.</div>
    <div class="comments"><p>I disagree, strongly, with this.</p></div><script>var t="</p>";</script></body></html>"""
    assert html_extraction.main_text(page) == "Head\nFirst, a bold word. Then <more>.\nSecond; one, two, three."
    article = "<body><p>menu, menu, menu, menu.</p><article><h1>T</h1><p>a<br>b<p>c.</article><footer>f</footer>"
    assert html_extraction.main_text(article).split("\n")[-3:] == ["T", "a b", "c."]
    assert html_extraction.main_text("") == "" and html_extraction.main_text("a &amp; b") == "a & b"


def test_html_container_by_scores():
    long = "Words, and words, and more words; they go on, and on, until the end of the line."
    many = "".join(f"<p>{k} {long}</p>" for k in range(6))
    lines = [f"{k} {long}" for k in range(6)]
    # Short blocks after long ones stay, without article or main.
    listed = f"<body><div>menu</div><div id=content><h1>T</h1>{many}<ul><li>one<li>two</ul><p>End</div>"
    assert html_extraction.main_text(listed).split("\n") == ["T", *lines, "one", "two", "End"]
    # A lighter second article does not replace the first.
    second = "".join(f"<p>second {k} {long}</p>" for k in range(5))
    two = html_extraction.main_text(f"<body><article>{many}</article><article>{second}</article>").split("\n")
    assert two == [*lines, *(f"second {k} {long}" for k in range(5))]
    # Nor does an article element that holds next to nothing; sections of one are all kept.
    aside = f"<body><article><p>Teaser</p></article><div>{many}</div>"
    assert html_extraction.main_text(aside).split("\n")[-6:] == lines
    parts = f"<body><article><section>{many}</section><section><p>Short end</p></section></article>"
    assert html_extraction.main_text(parts).split("\n") == [*lines, "Short end"]
    # A head that nothing closes ends where the body begins, marked or not.
    for opened in ("<body>", ""):
        page = f"<html><head><meta charset=utf-8><title>t</title>{opened}<div>{many}</div>"
        assert html_extraction.main_text(page).split("\n") == lines


def test_html_query_gives_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    import html

    for r in QUERIES["op4_html_extraction"](spark, FOLDER).collect():
        inner = re.search(r"(?s)<article>(.*?)</article>", pages[r.page_id])[1]
        lines = re.sub(r"</?(?:p|h1)>", "\0", inner).split("\0")
        plain = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in lines]
        assert r.text == "\n".join(x for x in plain if x) and r.n_chars == len(r.text)


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    chain = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    judged = toxicity.predict(docs, chain).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = sum(r.is_toxic == bool(r.toxic) for r in judged)
    assert right / len(judged) > 0.85
    assert not any(r.is_toxic for r in judged if not r.toxic)
    empty = toxicity.fit(docs, labels.limit(0))
    odd = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string").withColumn("is_toxic", F.lit("clash"))
    assert [r.is_toxic for r in toxicity.predict(odd, empty).collect()] == [False, False]
    assert not any(r.is_toxic for r in toxicity.predict(odd, chain).collect())


def test_toxicity_copies_do_not_displace_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    # Copies of one labelled text with more words than a list of 256 holds.
    text = " ".join("z" + chr(97 + i // 26) + chr(97 + i % 26) + "q" * (i % 7) for i in range(600))
    copies = spark.range(10**9, 10**9 + 100).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    chain = toxicity.fit(docs.union(copies), labels.union(copies.select("doc_id", F.lit(1))))
    judged = toxicity.predict(docs, chain).join(labels.where("toxic = 1"), "doc_id").collect()
    words = set("scum idiot trash moron loser stupid clown worthless pathetic disgusting".split())
    known = [r.is_toxic for r in judged if words & set(toxicity.words_of(r.text))]
    assert known and sum(known) / len(known) > 0.9


def test_toxicity_at_small_sizes(spark):
    def recall(size: str) -> dict[str, float]:
        docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text", "lang")
        labels = spark.read.parquet(f"/root/testdata/{size}/labels.parquet")
        judged = toxicity.predict(docs, toxicity.fit(docs, labels)).join(labels, "doc_id")
        assert judged.where("is_toxic AND toxic = 0").count() == 0
        hits = judged.where("toxic = 1").groupBy("lang").agg(F.avg(F.col("is_toxic").cast("int")).alias("share"))
        return {r.lang: r.share for r in hits.collect()}

    # 11 and 51 toxic rows.
    assert recall("sf0.001")["en"] > 0.9
    shares = recall("sf0.01")
    assert shares["en"] > 0.9 and min(shares.values()) > 0.3
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert 0 < corpus_pipeline.drop_toxic(spark, docs, FOLDER).count() < docs.count()


def test_decontamination_cases(spark):
    item = " ".join(f"i{k}" for k in range(20))
    bench = spark.createDataFrame([(1, item), (2, "Short item"), (3, None), (4, "!!"), (5, item)], "item_id long, text string")
    rows = [(1, f"x {item.upper()} y"), (2, "a short-item, indeed"), (3, None), (4, "w " * 500 + "short item"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("items", F.lit("clash"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.items, r.contaminated) for r in wu_manber.decontaminate(docs, bench).collect()}
    assert got == {1: (22, 20, ["1", "5"], True), 2: (4, 2, ["2"], True), 3: (0, 0, [], False),
                   4: (502, 2, ["2"], False), 5: (0, 0, [], False)}
    assert not any(r.contaminated for r in wu_manber.decontaminate(docs, bench.limit(0)).collect())


def _base(text: str) -> list[tuple[str, int, int]]:
    out = []
    forms = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for kind, form in forms.items():
        for m in re.finditer(form.replace(r"[\x20-]", "[ -]"), text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_pii_equals_patterns():
    rng = random.Random(7)
    texts = ["".join(rng.choices("ab1234.@+-() \n%é", k=rng.randint(0, 60))) for _ in range(20000)]
    texts += ["4111 1111 1111 1111, 10.0.0.256 and 1.2.3.4.5 a@b@c.de +1 (555) 555-0100", "1" * 5000, "a" * 5000 + "@", ""]
    for text in texts:
        assert [(k, a, b) for k in pii.KINDS for a, b in pii.base_spans(text)[k]] == _base(text)


def test_pii_disguises(spark):
    text = "é mail jоhn@exаmple.com or bob (at) mail [dot] org, call + one two three four five six seven eight"
    base, every = pii.all_spans(text)
    found = {(kind, text[a:b]) for kind, spans in every.items() for a, b in spans}
    assert ("email", "jоhn@exаmple.com") in found and ("email", "bob (at) mail [dot] org") in found
    assert all(set(base[k]) <= set(every[k]) for k in base)
    df = spark.createDataFrame([(1, "to a@b.cd now"), (2, None), (3, "")], "doc_id long, text string").withColumn("spans", F.lit("x"))
    assert [r.text for r in pii.redact(df).collect()] == ["to <email> now", None, ""]
    assert pii.redact(df).columns == df.columns and pii.find(df.limit(0)).count() == 0


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "tokens"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, kept, FOLDER)
        assert kept.columns == docs.columns
        if stage is corpus_pipeline.drop_near_duplicates:
            wanted = _groups({r.doc_id: r.text for r in before.collect()}, 5)
            assert {r.doc_id for r in kept.collect()} == {i for i, w in wanted.items() if w[2]}
    assert {r.doc_id for r in rows} == {r.doc_id for r in kept.collect()}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
