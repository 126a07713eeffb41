"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from assayflow.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def _rows(columns, rows):
    at = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([round(r[i], 9) if isinstance(r[i], float) else r[i] for i in at]) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, tables, name):
    df, expected = QUERIES[name](spark, SF), tables.sql(ORACLES[name])
    assert _rows(df.columns, df.collect()) == _rows(expected.columns, expected.fetchall())


def test_built_in_operators_run_no_python(spark):
    allowed = {"dumped_collection", "xml_tables", "ast_table_filter", "ast_table_text", "ast_table_scan", "supplement_refs", "data_availability"}
    for name in set(QUERIES) - allowed:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan, name


def test_entry_imports_without_the_optional_subpackage():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
