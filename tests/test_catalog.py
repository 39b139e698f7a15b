"""Queries that have a SQL counterpart must agree with it."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import rows_of

SF = "/root/testdata/sf0.001"
SLOW = {
    "kmeans_properties", "oof_coverage", "contribution_additivity", "model_round_trip", "note_cluster_coverage", "outlier_share",
    "kmeans_segments", "note_clusters", "gbt_oof_scores", "search_trials", "fold_importance", "shap_summary", "lead_predictions",
    "conversion_predictions", "topup_action_list", "topup_table", "topup_stored", "conversion_stored",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.parametrize("name", [n for n in oracle_sql() if n not in SLOW])
def test_query_agrees_with_sql(spark, con, name):
    df = queries()[name](spark, SF)
    rel = con.execute(oracle_sql()[name])
    columns = [c[0] for c in rel.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, rel.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_text_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
