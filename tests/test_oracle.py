"""Every warehouse query against its DuckDB oracle on the test tables (the
training-data queries have their own tests, where their subpackage is)."""

from __future__ import annotations

import pytest
from conftest import SF_MEDIUM, SF_SMALL
from oracle import compare, duck

import __spark_entry__ as entry

def _warehouse(named: dict) -> dict:
    return {n: x for n, x in named.items() if not n.startswith("op") and n != "pipeline"}


QUERIES = _warehouse(entry.queries())
ORACLES = _warehouse(entry.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_small(spark, con_small, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con_small, ORACLES[name])
    assert r["ok"], r


@pytest.fixture(scope="module")
def con_medium():
    return duck(SF_MEDIUM)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_medium(spark, con_medium, name):
    """The driver's correctness gate: every query at sf0.01."""
    r = compare(QUERIES[name](spark, SF_MEDIUM), con_medium, ORACLES[name])
    assert r["ok"], r


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["ship_mode", "avg_shipping_days"]
    assert len(rows) == 5
    days = [r["avg_shipping_days"] for r in rows]
    assert days == sorted(days, reverse=True)


def test_medium_sizes_match_the_fixture_notes(spark):
    """Sizes recorded for the adapter at sf0.01."""
    fact = QUERIES["sales_fact"](spark, SF_MEDIUM)
    assert fact.count() == 299_449
    assert fact.where("geo_id IS NULL").count() == 8_663


@pytest.mark.parametrize("bound", [0, 3000])
def test_fact_shuffle_paths_match_oracle(spark, con_small, bound):
    """With little or no room to broadcast, the merge-join (and hot-key)
    paths give the oracle's fact on the real tables."""
    from starweave.plans import (customer_dim, geo_dim, product_dim, sales_fact,
                                 shipping_dim, stg_orders)
    from starweave.session import stored
    from starweave.sources import raw_orders_from_tpch
    stg = stg_orders(stored(raw_orders_from_tpch(spark, SF_SMALL)))
    dims = [stored(f(stg)) for f in (customer_dim, product_dim, shipping_dim, geo_dim)]
    fact = sales_fact(stg, *dims, max_broadcast_bytes=bound)
    r = compare(fact, con_small, ORACLES["sales_fact"])
    assert r["ok"], r
