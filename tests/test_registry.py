"""Registered queries against their SQL oracles. ALL_QUERIES=1 runs every query that has one."""

import os

import pytest

import __spark_entry__ as contract
from tools.check_oracle import duck, rows_of

SAMPLE = ["abc_curve", "fact_sales", "silver_clientes", "silver_carteira", "mart_vendedor", "mart_financeiro",
          "order_gaps", "feature_table", "univariate_auc", "score_bands", "crosssell_candidates", "weekly_queue",
          "suggest_products_strict", "customer_context", "kpi_monthly", "quality_suite", "dim_calendario"]
NAMES = [n for n in contract.oracle_sql()] if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, sf_dir, con, name):
    df = contract.queries()[name](spark, sf_dir)
    cur = con.execute(contract.oracle_sql()[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    without = set(contract.DOMAIN) - set(contract.oracle_sql())
    assert not without
    assert contract.entry(spark).columns[:2] == ["sku", "categoria"]
