"""Every registered query against its independent SQL on a second engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from clickmart.plans.registry import QUERIES as REGISTERED
from tests.compare import compare, duck
from tests.conftest import SF_SMALL

SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTERED}
QUERIES = {name: q for name, q in entry.queries().items() if name in REGISTERED}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) >= 45


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), SQL[name], SF_SMALL, con)
    assert r["rows_match"], r["rows"]
    assert r["cols_match"], (r.get("spark_cols"), r.get("oracle_cols"))
    assert r["hash_match"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "customer_tier" in df.columns


SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def test_column_types_match_oracle(spark, con):
    """Same column names and the same types on both engines, for every query."""
    mismatched = {}
    for name in sorted(QUERIES):
        sdf = QUERIES[name](spark, SF_SMALL)
        got = {f.name: SPARK_TO_SQL.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
        rel = con.sql(SQL[name])
        want = dict(zip(rel.columns, [str(t) for t in rel.types]))
        if got != want:
            mismatched[name] = {k: (got.get(k), want.get(k)) for k in set(got) | set(want) if got.get(k) != want.get(k)}
    assert not mismatched, mismatched
