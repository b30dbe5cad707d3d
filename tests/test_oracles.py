"""Every registered query against its SQL twin on the given tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from tallymart import derived
from tallymart.plans.oracles import ORACLES
from tallymart.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in derived.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    actual = _sorted(tuple(row[c] for c in columns) for row in result.collect())
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert actual == _sorted(tuple(row[i] for i in order) for row in expected.fetchall())
    assert actual


def test_entry_is_the_fact_table(spark):
    fact = entry_module.entry(spark)
    assert fact.columns == [
        "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id",
        "sales", "quantity", "discount", "profit", "returned",
    ]
    assert fact.count() == 5942


def test_golden_counts(spark):
    def count(name):
        return QUERIES[name](spark, SF_DIR).count()

    lines = QUERIES["collapse_order_lines"](spark, SF_DIR)
    assert lines.count() == 5942
    sums = lines.selectExpr(
        "sum(quantity)", "CAST(sum(CAST(sales AS DECIMAL(18,2))) AS STRING)",
        "CAST(sum(CAST(profit AS DECIMAL(18,2))) AS STRING)", "count_if(discount IS NULL)",
    ).first()
    assert tuple(sums) == (152257, "317364757.31", "232011602.73", 287)
    assert count("star_customers") == 1443
    assert count("star_customers_by_id") == 150
    assert count("star_products") == 200
    assert count("star_regions") == 5
    assert count("dup_rows_all") == 115
    assert count("dup_rows_later") == 954
    assert count("reconcile_mismatches") == 1015
    assert count("merge_customers") == 1176 + 13
    flags = QUERIES["flag_returned"](spark, SF_DIR).groupBy("returned").count().collect()
    assert {r["returned"]: r["count"] for r in flags} == {"Yes": 1204, "No": 4738}
