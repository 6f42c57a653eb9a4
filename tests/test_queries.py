"""Every registered query against its SQL, and its plan."""

import re

import pytest

import __spark_entry__ as repo
from conftest import FOLDER
from tools.check import compare, connect

QUERIES, SQL = repo.queries(), repo.oracle_sql()
# blocks of vectors are compared, tiles of a matrix multiplied and a network run in numpy
PYTHON_TASKS = {"l6_neighbour_vote", "j9_matrix_product", "l16_batch_predictions"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_TASKS:
        assert not re.search(r"PythonUDF|InPandas|CoGroups", plan)
    # no window over the whole table in one task
    for spec in re.findall(r"windowspecdefinition\(([^,]*),", plan):
        assert not re.search(r" (ASC|DESC) ", spec), spec
    if name in SQL:
        assert compare(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    row = repo.entry(spark).first()
    assert row["NumPrimaryKeys"] > 0 and row["NumDuplicatedPrimaryKeys"] >= 0


def test_no_query_takes_part_of_a_table():
    """No filter on a remainder of a row id and no limit but in the reports of first or last rows."""
    limited = {n for n, s in SQL.items() if re.search(r"\bLIMIT\b", s)}
    assert limited == {"t2_first_rows", "t2_last_rows", "t3_most_wrong", "t7_sample_rows"}
    for name, sql in SQL.items():
        assert not re.search(r"WHERE[^()]*_(id|key|custkey|orderkey) %", sql), name
