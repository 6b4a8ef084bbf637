"""Every registered query against its DuckDB SQL at sf0.001 (row count,
column names, order-insensitive value hash)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare, duck
from starloom.oracle import ORACLE_SQL as SQL
from starloom.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert r["cols_match"], r["cols"]
    assert r["rows"][0] == r["rows"][1]
    assert r["hash_match"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "sales_key"
    assert df.count() > 0


def test_entry_schema_is_the_documented_fact_schema(spark):
    """FIXTURES.md section 4: the sales fact's columns and types."""
    want = [("sales_key", "string"), ("product_key", "bigint"), ("customer_key", "bigint"),
            ("ship_address_key", "bigint"), ("order_status_key", "bigint"),
            ("creditcard_key", "bigint"), ("salesorderid", "bigint"),
            ("salesorderdetailid", "bigint"), ("unitprice", "decimal(12,2)"), ("orderqty", "int"),
            ("orderdate", "date"), ("revenue", "decimal(18,2)")]
    got = [(f.name, f.dataType.simpleString()) for f in entry.entry(spark).schema.fields]
    assert got == want
