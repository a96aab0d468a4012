"""Queries against their SQL on the smallest data; tools/check_oracles.py runs them all."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracles import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "catalog_union_totals", "input_contract", "json_array_repair", "compose_statements",
    "label_freeform", "rating_label_mean", "judge_labels", "unmapped_labels",
    "numeric_profile", "histogram_40", "boxplot_by_level", "first_example", "vocabulary",
    "tfidf_bigrams", "fold_document_frequency", "similar_topk", "knn_label", "class_report",
    "leaderboard", "f1_grid", "recommend_relaxed", "recommend_user_level", "few_shot_label",
    "pack_requests", "parse_replies", "cached_predictions", "near_duplicate_classes",
    "near_duplicate_pairs", "pack_requests_by_size", "csv_records", "json_array_records",
    "resume_labels", "recommend_effective", "catalog_concepts", "chosen_queries", "concept_jaccard",
]


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sql, name):
    df = queries()[name](spark, FOLDER)
    cursor = sql.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(columns, cursor.fetchall())


def test_entry_and_keys(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
