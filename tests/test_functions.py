from __future__ import annotations

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from gradus.functions import concepts, labels, text
from gradus.functions.folding import _BLOCKS, fold_accents, fold_string


def plain_clean(value: str) -> str:
    """Text cleaning in plain Python."""
    value = re.sub(r"`{1,3}.*?`{1,3}", " ", value.lower(), flags=re.DOTALL)
    value = "".join(
        c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c)
    )
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", value)).strip()


SAMPLES = [
    "Programação  Dinâmica, 2ª edição!",
    "a `code\nspan` b ``two`` c",
    "ﬁm ½ x² ™ ℌ Ⅷ ⑫ ㍿ é",
    "İstanbul   straße 　 ＡＢＣ１２",
    "한국어 日本語 русский ё 𝐚𝐛𝐜 🙂",
    "",
    "   \n\t",
]


def test_clean_text_matches_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "i int, t string")
    got = {r.i: r.c for r in df.select("i", text.clean_text(F.col("t")).alias("c")).collect()}
    assert got == {i: plain_clean(t) for i, t in enumerate(SAMPLES)}


def test_clean_text_matches_on_every_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for row in docs.select("text", text.clean_text(F.col("text")).alias("c")).collect():
        assert row.c == plain_clean(row.text)


def test_clean_text_of_null_is_empty(one):
    assert one(text.clean_text, None) == ""


def test_folding_tables_cover_every_character_but_hangul(spark):
    looked_at = {p for block in _BLOCKS for p in block}
    for point in range(0x80, 0x110000):
        if point in looked_at or 0xD800 <= point < 0xE000 or 0xAC00 <= point < 0xD7A4:
            continue
        assert fold_string(chr(point)) == chr(point)


def test_fold_accents(one):
    value = "Muito Fácil ﬁ ™ ё Å ½"
    assert one(fold_accents, value) == fold_string(value)


def test_stopwords_and_short_words_drop_out(one):
    assert one(text.clean_words, "O menino e a Árvore x não the tree") == "menino arvore tree"
    assert one(lambda c: text.clean_words(c, ("tree",)), "the tree a") == "the"


def test_ngrams(one):
    grams = one(lambda c: text.ngrams(F.split(c, " "), 3), "a b c")
    assert grams == ["a", "b", "c", "a b", "b c", "a b c"]
    assert one(lambda c: text.ngrams(F.split(c, " "), 2), "a") == ["a"]


def test_compose_keeps_original_example_number(spark):
    df = spark.sql(
        "select ' D ' d, cast(null as string) i, 'o' o, array(named_struct('input', ' ', "
        "'output', cast(null as string)), named_struct('input', '1 ', 'output', '2')) t"
    )
    out = df.select(
        text.compose_statement(F.col("d"), F.col("i"), F.col("o"), F.col("t")).alias("s")
    ).first().s
    assert out == "D\n\nSaída\no\n\nExemplo 2\nEntrada: 1\nSaída: 2"


def test_snippet(one):
    assert one(lambda c: text.snippet(c, 3), " a \n b  cd ") == "a b…"
    assert one(lambda c: text.snippet(c, 9), " a   b ") == "a b"


def test_standard_label(one):
    assert one(text.standard_label, " Facil ") == "facil"
    assert one(text.standard_label, " NaN ") is None


@pytest.mark.parametrize(
    ("answer", "label"),
    [
        ("Very Hard", "muito_dificil"),
        ("muito-fácil", "muito_facil"),
        ("seria dificil", "dificil"),
        ("abc def", "abc_def"),
        ("  MÉDIA ", "medio"),
        ("it is very_easy I think", "muito_facil"),
        ("", ""),
    ],
)
def test_parse_label(one, answer, label):
    assert one(labels.parse_label, answer) == label


def test_rounding_and_levels(one):
    assert one(labels.round_half_up, 2.5) == 3
    assert one(labels.round_half_up, 1.49) == 1
    assert one(labels.level_of, 0) == "muito_facil"
    assert one(labels.level_of, 9) == "muito_dificil"
    with pytest.raises(ValueError, match="strategy"):
        labels.label_by("median", F.lit(1), F.lit(1))


def test_judge_label(one):
    assert one(labels.judge_label, " SUPER Fácil") == "muito_facil"
    assert one(labels.judge_label, "  ") is None
    assert one(labels.judge_label, "unknown") is None


def test_collapse(one):
    assert one(labels.collapse, "muito_dificil") == "dificil"
    assert one(labels.collapse, "x") is None
    assert one(lambda c: labels.collapse(c, keep_unknown=True), "x") == "x"
    assert one(lambda c: labels.collapse(c, keep_unknown=True), None) is None


def test_level_relation(one):
    assert one(lambda a, b: labels.level_relation(a, b), 2, 1) == "below"
    assert one(lambda a, b: labels.level_relation(a, b), 2, 5) == "above"
    assert one(lambda a, b: labels.level_gap(a, b), 2, 5) == 3
    assert one(lambda a, b: labels.level_relation(a, b.cast("int")), 2, None) == "unknown"


def test_concepts(one):
    assert sum(one(concepts.one_hot, ["Árvores", "busca-binária", "other"])) == 2
    back = one(lambda c: concepts.concept_set(concepts.one_hot(c)), ["grafos", "arvores", "x"])
    assert back == ["arvores", "grafos"]
    assert one(lambda a, b: concepts.jaccard(a, b), ["a", "b"], ["b", "c"]) == pytest.approx(1 / 3)
    assert one(lambda a, b: concepts.jaccard(a, b), [], []) == 0
    assert one(lambda a, b: concepts.common_concepts(a, b), ["b", "", "a"], ["a", "", "b"]) == ["a", "b"]
    tags = one(lambda w: concepts.tag_by_words(w, {"tree": "arvores", "sum": "matematica"}), ["tree", "sum", "tree"])
    assert tags == ["arvores", "matematica"]
