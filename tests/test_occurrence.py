"""Numbers of identical raw rows, with and without a whole-row shuffle."""

from __future__ import annotations

from collections import Counter

import pytest

from vitaldf.operators import records


def numbered(df):
    got = [(r["origin"], r["line"], r["occurrence"]) for r in records.with_occurrence(df).collect()]
    assert len(set(got)) == len(got)
    return Counter(g[:2] for g in got), got


def plan(df):
    return records.with_occurrence(df)._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_copies_stay_in_place(spark):
    df = spark.range(500).selectExpr("'f' origin", "concat('line ', id) line")
    counts, got = numbered(df)
    assert len(counts) == 500 and {g[2] for g in got} == {1}
    assert "Aggregate" not in plan(df) and "Join" not in plan(df)


@pytest.mark.parametrize("most", [1 << 16, 1])
def test_copies_are_numbered_from_one(spark, monkeypatch, most):
    """A few copies beside many rows, nulls and blanks among them; or more hashes than are sent to tasks."""
    monkeypatch.setattr(records, "MAX_REPEATED", most)
    rows = [("f", f"l{i}") for i in range(900)] + [("f", "l5")] * 3 + [("g", None)] * 2 + [(None, "g"), ("g", "l5")]
    counts, got = numbered(spark.createDataFrame(rows, "origin string, line string").repartition(3))
    assert counts == Counter(rows)
    assert {g[2] for g in got if g[:2] == ("f", "l5")} == {1, 2, 3, 4}


def test_many_copies_and_an_empty_table(spark):
    df = spark.range(40_000).selectExpr("'f' origin", "if(id % 2 = 0, 'same', concat('x', id % 100)) line")
    counts, _ = numbered(df)
    assert counts["f", "same"] == 20_000 and sum(counts.values()) == 40_000
    assert numbered(df.where("origin is null"))[1] == []
