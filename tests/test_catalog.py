import duckdb
import pytest

from check import TABLES, canonical
from shelfcast.operators import trees
from shelfcast.plans import catalog, oracles

DATA = "/root/testdata/sf0.001"
ORACLE = oracles.oracle_sql()
UNCHECKED = {
    "gbt_forecast", "feature_importance", "top_features", "score_skus", "arima_forecast", "ensemble_forecast",
    "holdout_mape", "cv_scores",
}


@pytest.fixture(scope="module")
def duck():
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return base


def test_only_model_dependent_queries_have_no_sql():
    assert set(catalog.QUERIES) - set(ORACLE) == UNCHECKED
    assert set(ORACLE) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    query = catalog.QUERIES[name](spark, DATA)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python
    mine = query.toPandas()
    theirs = duck.execute(ORACLE[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert canonical(mine) == canonical(theirs)


@pytest.mark.parametrize("name", sorted(UNCHECKED))
def test_model_query_returns_rows(spark, name, monkeypatch):
    # All rounds take minutes; that they run is up to the catalog, which overrides none.
    monkeypatch.setitem(trees.TREE_SETTINGS, "rounds", 3)
    assert catalog.QUERIES[name](spark, DATA).count() > 0
