"""Every registered query against its SQL."""

import re

import pytest

import __spark_entry__ as entry_module
import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_registry():
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries)
    own = {name for name in queries if not re.match(r"op\d+_|pipeline$", name)}
    assert own <= set(sql)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry_module.queries()[name](spark, SF)
    sql = entry_module.oracle_sql()[name]
    assert oracle.spark_rows(df) == oracle.sql_rows(con, sql)
    assert oracle.type_mismatches(df, con, sql) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() == 20
