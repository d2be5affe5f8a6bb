"""Registered queries vs their DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from vitaldf.plans import catalog  # noqa: E402
from oracle_compare import digest, norm  # noqa: E402
from vitaldf.plans.testdata import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
REFERENCE = sorted(catalog.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["timestamp", "source", "data_type", "sub_type", "steps", "steps_unit",
                          "steps_confidence"]
    ts = [r["timestamp"] for r in rows]
    assert all(t is not None for t in ts)


def test_every_query_has_a_name_and_most_an_oracle():
    qs, sqls = E.queries(), E.oracle_sql()
    assert len(qs) >= 150
    assert set(sqls) <= set(qs)
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", REFERENCE)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    drows = [tuple(norm(r[i]) for i in order) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert digest(srows) == digest(drows)
