"""Every registered query against its SQL, or for shape where SQL cannot state it."""

import os

import pytest

import __spark_entry__ as driver
import compare
from workload.oracle import SQL
from workload.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")

# Fitted models and random parts have no SQL; queries named _checks and _decided state what must
# hold of them. Full-size comparisons take minutes; tests/test_ml.py compares small ones.
FITTED = {
    "lr_grid_cv": ["reg_param", "elastic_net_param", "cv_auc", "cv_std", "chosen", "roc_auc",
                   "weighted_f1", "accuracy"],
    "feature_importance": ["feature", "importance"],
    "batch_scores": ["trip_id", "prediction", "delay_probability", "verdict"],
    "random_split": ["trip_id", "is_test"],
}
LONG = {"model_comparison"}


@pytest.fixture(scope="module")
def base():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, base, name):
    frame = QUERIES[name](spark, FOLDER)
    assert compare.differences(frame, base, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(FITTED))
def test_whole_rows_of_fitted_queries(spark, base, name):
    frame = QUERIES[name](spark, FOLDER)
    assert frame.columns == FITTED[name]
    rows = frame.collect()
    if name in ("batch_scores", "random_split"):
        events = base.sql("SELECT count(*) FROM events").fetchall()[0][0]
        assert len(rows) == len({r.trip_id for r in rows}) == events
    elif name == "feature_importance":
        assert len(rows) == 11 and abs(sum(r.importance for r in rows) - 1) < 1e-9
    else:
        assert len(rows) == 4 and [r.chosen for r in rows].count(True) == 1
        best, = [r for r in rows if r.chosen]
        assert best.cv_auc == max(r.cv_auc for r in rows) and 0 <= best.roc_auc <= 1
        assert all(r.roc_auc is None for r in rows if not r.chosen)


def test_every_query_is_checked():
    assert set(QUERIES) == set(SQL) | LONG | set(FITTED)
    assert set(QUERIES) <= set(driver.queries())


def test_entry_has_ten_routes(spark):
    assert driver.entry(spark).count() == 10
