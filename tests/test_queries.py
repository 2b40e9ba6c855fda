"""Each query against its DuckDB text, on the smallest tables."""

import datetime
import os

import duckdb
import pytest

from docquarry.plans import queries as plans
from docquarry.plans import chains, kept, uploads  # noqa: F401  (register their queries)
from docquarry.streaming import queries as streams

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = plans.QUERIES | streams.QUERIES, plans.SQL | streams.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(x[i]) for i in at) for x in relation.fetchall()), key=repr)


def test_every_outcome_occurs(spark):
    outcomes = {r["outcome"] for r in QUERIES["funnel_outcome"](spark, "/root/testdata/sf0.01").collect()}
    assert outcomes == {"complete", "review:incomplete", "review:gates_exhausted", "review:duplicate"}
    told = QUERIES["gate_verdict"](spark, SF).collect()
    for part in ("grounding=fail", "grounding=pass", "arithmetic=fail", "arithmetic=inconclusive", "arithmetic=not_applicable", "iban_mod97=fail", "plausibility=fail"):
        assert any(part in r["gates"] for r in told)
    assert {r["result"] for r in QUERIES["triage_classify"](spark, "/root/testdata/sf0.01").collect()} == {
        "dispatched", "duplicate", "zero_byte", "unsupported_mime", "encrypted", "corrupt", "page_ceiling",
    }


def test_gates_are_lazy_until_they_are_kept(spark):
    """Kept by an explicit step, and then read; either way with the same rows."""
    from docquarry.plans import invoices

    sf = "/root/testdata/sf0.001"
    scans = lambda frame: {f.rpartition("/")[2] for f in frame.inputFiles()}
    before = QUERIES["gate_verdict"](spark, sf)
    lazy = invoices.gated(spark, sf)
    assert "orders.parquet" in scans(lazy) and "lineitem.parquet" in scans(lazy)
    want = sorted(map(tuple, before.collect()))
    invoices.keep_gates(spark, sf)
    assert "orders.parquet" not in scans(invoices.gated(spark, sf))
    assert sorted(map(tuple, QUERIES["gate_verdict"](spark, sf).collect())) == want
