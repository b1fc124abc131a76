"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.check_oracles import connect, difference

SF_DIR = "/root/testdata/sf0.001"
OWN = {n: q for n, q in contract.queries().items() if n in contract.QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    problem = difference(got, duck.execute(contract.oracle_sql()[name]).df())
    assert problem is None, problem


def test_every_twin_belongs_to_a_query():
    assert set(OWN) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["query_id", "doc_id", "start", "score", "rank"]


def test_items_quoted_in_documents_are_found(spark, duck):
    """A search for a text that a document contains word for word should find that document."""
    hits = contract.queries()["keyword_plain"](spark, SF_DIR)
    first = {r.query_id: r.doc_id for r in hits.where("rank = 1").collect()}
    quoted = duck.execute(
        "SELECT item_id, list(doc_id) FROM benchmark b JOIN documents d"
        " ON contains(d.text, b.text) GROUP BY item_id"
    ).fetchall()
    found = {(r.query_id, r.doc_id) for r in hits.collect()}
    assert quoted and all(i in first for i, _ in quoted)
    hit = [any((i, d) in found for d in docs) for i, docs in quoted]
    assert sum(hit) >= 0.5 * len(hit)
