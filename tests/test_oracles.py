"""Every registered query with SQL against DuckDB, on the smallest test tables."""

import pytest

from __spark_entry__ import entry
from demandcast.catalog.oracles import oracles as oracle_sql
from demandcast.catalog.queries import QUERIES
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_all_oracles_have_a_query():
    assert set(oracle_sql()) <= set(QUERIES)
    assert set(QUERIES) - set(oracle_sql()) == {
        "model_fitted", "predict_model", "lambda_scores", "recursive_model", "backtest", "forecast_run_model", "batch_runs"
    }


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, db, name):
    ours = QUERIES[name](spark, SF_DIR).toPandas()
    assert compare(ours, db.sql(oracle_sql()[name]).df()) == ""


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
