"""Every query that DuckDB can express gives the same rows; all others run and give rows."""

import pytest
from comparison import connect, duck_rows, spark_rows

from quire.plans import catalogue

QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    cols, rows = spark_rows(QUERIES[name](spark, data))
    assert rows
    if name in ORACLES:
        names, want = duck_rows(con, ORACLES[name])
        assert cols == names
        assert rows == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(5).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["words_in_box", "words_outside_tables", "iou_best_match", "continuation_pairs", "box_geometry"])
def test_no_cartesian_plans(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
