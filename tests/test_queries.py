import duckdb
import pytest

import __spark_entry__ as entry
from indicora.plans.oracles import ORACLES
from indicora.plans.queries import REGISTRY
from tools.check_queries import TABLES, compare

SLOW = {"forest_metrics", "forest_forecast", "iforest_scores"}


@pytest.fixture(scope="module")
def db(tiny):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return connection


def test_every_answer_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(REGISTRY) - set(ORACLES) == SLOW


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - SLOW))
def test_query(spark, db, tiny, name):
    rows = entry.queries()[name](spark, tiny)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    got = rows.toPandas()
    assert compare(got, db.execute(entry.oracle_sql()[name]).df()) == ""


def test_scan_is_pruned_and_filtered(spark, tiny):
    plan = entry.queries()["risk_score"](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "c_name" not in plan and "c_acctbal" not in plan
