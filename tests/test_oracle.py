"""Every core query with a statement gives the statement's rows."""

import pytest

from oracle import compare, connection
from pagewright.plans import registry

CASES = {k: (f, m.SQL.get(k)) for m in registry.MODULES for k, f in m.QUERIES.items()}


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", [k for k, (_, s) in CASES.items() if s])
def test_matches_statement(spark, sf, con, name):
    compare(spark, *CASES[name], sf, con)


def test_index_recall(spark, sf):
    from pagewright.plans.export_queries import index_topk, vector_topk

    exact = {tuple(r) for r in vector_topk(spark, sf).select("query_id", "id").collect()}
    near = {tuple(r) for r in index_topk(spark, sf).select("query_id", "id").collect()}
    assert len(exact & near) / len(exact) >= 0.9


def test_registry_names_are_unique():
    names = [k for m in registry.MODULES for k in m.QUERIES]
    assert len(names) == len(set(names))
