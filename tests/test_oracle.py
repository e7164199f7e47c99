"""Every registered query against its SQL, and properties of all plans."""

from __future__ import annotations

import datetime
import os
import re

import duckdb
import pytest

from registry import oracle, queries, views
from subscore.plans import jobs
from tests.conftest import TESTDATA

QUERIES = queries.all_queries()
STATEMENTS = oracle.all_statements()

@pytest.fixture(scope="module")
def duck(data_folder):
    connection = duckdb.connect()
    for name in os.listdir(data_folder):
        table, _ = os.path.splitext(name)
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data_folder}/{name}'")
    yield connection
    connection.close()


def _text(value):
    if isinstance(value, datetime.datetime):
        return repr(value.replace(tzinfo=None))
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, TESTDATA)
    theirs = duck.execute(STATEMENTS[name])
    names = [d[0] for d in theirs.description]
    types = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    types |= {"date": "DATE", "timestamp": "TIMESTAMP"}
    assert {c: types[t] for c, t in ours.dtypes} == {d[0]: str(d[1]) for d in theirs.description}
    expected = sorted(tuple(_text(r[names.index(c)]) for c in ours.columns) for r in theirs.fetchall())
    assert sorted(tuple(_text(v) for v in r) for r in ours.collect()) == expected
    assert expected


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["build_training_set", "build_scoring_set", "usage_datamart", "ntile_exact"])
def test_plans_stay_inside_the_engine(spark, data_folder, name):
    plan = _plan(QUERIES[name](spark, data_folder))
    for operator in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    assert "PushedFilters" in plan


def test_features_shuffle_the_spine_once(spark, data_folder):
    """Five joins, and the spine is exchanged once for all of them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = views.monthly_tables(spark, data_folder, views.SCORING_MONTH)
        plan = _plan(jobs.build_scoring_set(tables, views.AS_OF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("LeftOuter, (prof_month") == 5
    (spine_key,) = set(re.findall(r"SortMergeJoin \[(analytic_id#\d+, register_date#\d+)\], \[_right", plan))
    assert plan.count(f"Exchange hashpartitioning({spine_key}, ") == 1
    # The pivoted history arrives partitioned as its join needs it.
    assert plan.count("hashpartitioning(_right_analytic_id") == 3
    # No subscriber-grain exchange to a single task: only the means end in one.
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "partial_avg" in part.splitlines()[1]
