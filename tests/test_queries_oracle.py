"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from encore.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of

SQL = E.oracle_sql()
LIBRARY = set(QUERIES)  # the optional text operators have tests of their own
ROWS_ONLY = sorted(LIBRARY - set(SQL))
SLOW = {"cv_forest", "cv_binary", "cv_svm", "cv_multiclass", "cv_model_scores"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_is_registered_with_an_oracle_or_listed_as_rows_only():
    assert set(SQL) <= set(E.queries())
    assert set(ROWS_ONLY) == {
        "pca_project", "lr_binary", "svm_binary", "rf_binary", "binary_model_scores", "cv_binary", "cv_svm", "cv_model_scores",
        "cv_forest", "lr_multiclass", "multiclass_model_scores", "cv_multiclass", "als_predict", "als_ranking",
    }


@pytest.mark.parametrize("name", sorted(LIBRARY & set(SQL)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows, cols = df.collect(), df.columns
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(srows, cols) == rows_of(drows, dcols)


@pytest.mark.parametrize("name", [n for n in ROWS_ONLY if n not in SLOW])
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() > 0


@pytest.mark.parametrize("name", ["cold_start_users", "cold_start_items"])
def test_coverage_checks_find_cold_keys(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "song_id", "plays"]
    assert df.count() == 3112
