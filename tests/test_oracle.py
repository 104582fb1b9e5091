"""Every query against its SQL, cell by cell, on the driver's tables."""

import os
import re

import compare
import pytest

import __spark_entry__ as entry_module
from learnlog import schemas
from learnlog.ml import gbt, search
from learnlog.plans import catalog
from oracle import sql

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
SQL = sql.oracle_sql()
# Fitted models have no SQL; only these may go without.
MODELS = {"gbt_fit", "gbt_score", "param_search", "best_params", "rung_search"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == MODELS and not set(SQL) - set(QUERIES)


# Window groups. Draw prefixes and ranges are bounded in number, so a window over
# their totals may be ordered by them alone; `taken` marks the last draw prefix.
GROUPS = {"user_id", "content_id", "column", "_range", "fold", "head", "taken"}


def check_plan(plan):
    """No Python per row, no cross product of tables, no window over everything."""
    assert "EvalPython" not in plan and "Cartesian" not in plan
    for spec in re.findall(r"windowspecdefinition\(([^,)]*)", plan):
        assert spec.split("#")[0] in GROUPS, spec


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare.mismatch(df, con, SQL[name]) is None
    check_plan(df._jdf.queryExecution().executedPlan().toString())


def test_models_run(spark):
    scored = QUERIES["gbt_score"](spark, SF_DIR)
    assert scored.columns == ["row_id", schemas.TARGET, "score"] and scored.count() > 0
    fitted = QUERIES["gbt_fit"](spark, SF_DIR).collect()
    assert {(r["fold"], r["split"]) for r in fitted} == {
        (i, s) for i in range(5) for s in ("train", "valid")
    }
    assert all(0 <= r["auc"] <= 1 for r in fitted)
    by_row = {(r["fold"], r["split"]): r["auc"] for r in fitted}
    assert all(by_row[i, "train"] > by_row[i, "valid"] - 0.1 for i in range(5))


def test_searches_run(spark, monkeypatch):
    """The registered searches, with fewer points and rounds: whole ones take minutes."""
    monkeypatch.setattr(search, "TRIALS", 3)
    monkeypatch.setattr(search, "RUNG_TRIALS", 4)
    monkeypatch.setitem(gbt.PARAMS, "maxIter", search.FIRST_RUNG + 2)
    trials = QUERIES["param_search"](spark, SF_DIR).collect()
    assert sorted(r["trial"] for r in trials) == [0, 1, 2]
    assert all(0 <= r["auc"] <= 1 and 1 <= r["rounds"] <= 10 for r in trials)
    best = QUERIES["best_params"](spark, SF_DIR).collect()
    assert [r["auc"] for r in best] == [max(r["auc"] for r in trials)]
    rungs = QUERIES["rung_search"](spark, SF_DIR).collect()
    assert sorted((r["rung"], r["rounds"]) for r in rungs) == [(0, 8), (0, 8), (1, 10), (2, 10)]


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["row_id", *schemas.FEATURES, schemas.TARGET] and df.count() > 0
