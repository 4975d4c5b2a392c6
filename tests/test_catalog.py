"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, tables, name):
    frame = queries()[name](spark, SF)
    if name in SQL:
        assert differences(frame, tables, SQL[name]) is None
    else:
        assert frame.count() > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows
    for row in rows:
        assert row.positive_pct + row.neutral_pct + row.negative_pct == pytest.approx(100)
        assert len(row.top_positive.split(", ")) <= 5


def test_sql_has_a_query():
    assert set(SQL) <= set(queries())


def test_no_cartesian_plans(spark):
    names = ["sentiment_token_all", "rank_cafes_8", "category_word_counts", "cosine_university"]
    for name in [*names, "centroid_outliers", "merge_shop_text"]:
        frame = queries()[name](spark, SF)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
