"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as registered
from compare import both, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


OWN = {**registered.flags.QUERIES, **registered.scalars.QUERIES, **registered.files.QUERIES}


def test_every_query_has_sql():
    assert all(sql for _, sql in OWN.values())
    assert OWN.keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", sorted(OWN))
def test_same_rows_as_sql(spark, con, name):
    ours, theirs = both(spark, con, SF, registered.queries()[name], registered.oracle_sql()[name])
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
    assert sum(ours[1].values()) > 0 or name == "value_search"


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["MUNICIPIO", "INTELIGENTE", "CONTAGEM_COMM", "CONTAGEM_TOT", "DISP", "DATA"]
    assert df.count() > 0


@pytest.mark.parametrize("name, scans", [("availability_daily", 2), ("universe_left_join", 2)])
def test_readings_are_scanned_once_for_rows_and_once_for_days(spark, name, scans):
    df = registered.queries()[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.rindex("== Final Plan =="):plan.rindex("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert len(set(re.findall(r"FileScan parquet [^\n]*events.parquet[^\n]*", plan))) <= scans
