"""Explicit schemas and the level scales every other module refers to."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: must be exactly these for results to agree -----------------
LEVELS_5 = ["muito_facil", "facil", "medio", "dificil", "muito_dificil"]
LEVELS_3 = ["facil", "medio", "dificil"]

FIVE_TO_THREE = {
    "muito_facil": "facil",
    "facil": "facil",
    "medio": "medio",
    "dificil": "dificil",
    "muito_dificil": "dificil",
}

JUDGE_LABELS = {
    "super facil": "muito_facil",
    "facil": "facil",
    "medio": "medio",
    "dificil": "dificil",
    "super dificil": "muito_dificil",
}

CONCEPTS = [
    "matematica",
    "implementacao",
    "strings",
    "estruturas_de_dados",
    "recursao",
    "programacao_dinamica",
    "grafos",
    "arvores",
    "busca_binaria",
    "guloso",
    "ordenacao",
    "geometria",
    "teoria_dos_numeros",
    "backtracking",
    "forca_bruta",
]

SEED = 42
MAX_FEATURES = 5000
NGRAM_MAX = 2
MIN_DF = 2
CONCEPT_WEIGHT = 0.7
DUPLICATE_COSINE = 0.95
# ------------------------------------------------------------------------------


def levels(n: int) -> list[str]:
    """The ordered scale with ``n`` levels (5 or 3)."""
    if n == 5:
        return LEVELS_5
    if n == 3:
        return LEVELS_3
    raise ValueError(f"unknown scale: {n!r}; use 5 or 3")


QUESTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_ratings", T.IntegerType()),
        T.StructField("mean_rating", T.DoubleType()),
        T.StructField("mode_rating", T.IntegerType()),
        T.StructField("label", T.StringType()),
    ]
)

RATINGS = T.StructType(
    [
        T.StructField("question_id", T.LongType()),
        T.StructField("difficultylevel", T.IntegerType()),
    ]
)

JUDGE_RECORD = T.StructType(
    [
        T.StructField("ID", T.LongType()),
        T.StructField("Name", T.StringType()),
        T.StructField("URL", T.StringType()),
        T.StructField("Problem_Description", T.StringType()),
        T.StructField("Input", T.StringType()),
        T.StructField("Output", T.StringType()),
        T.StructField(
            "Test_Case",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("input", T.StringType()),
                        T.StructField("output", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "metadata", T.StructType([T.StructField("Difficulty", T.StringType())])
        ),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("accuracy_std", T.DoubleType()),
        T.StructField("f1_macro", T.DoubleType()),
        T.StructField("f1_macro_std", T.DoubleType()),
        T.StructField("f1_weighted", T.DoubleType()),
        T.StructField("params", T.StringType()),
    ]
)
