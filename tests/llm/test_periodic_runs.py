"""Periodic runs against the definition, on generated words, edge rows and the smallest driver table."""

from __future__ import annotations

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brute import WORD
from vitaldf.llm import periodic_runs, queries
from vitaldf.llm.periodic_runs import SquareCatcher

SF = "/root/testdata/sf0.001"


def runs_of(words, least=6, times=4):
    """Every maximal stretch of each distance, with its smallest period."""
    n, found = len(words), {}
    for p in range(1, n // times + 1):
        i = p
        while i < n:
            if words[i] != words[i - p]:
                i += 1
                continue
            first = i - p
            while i < n and words[i] == words[i - p]:
                i += 1
            if i - first >= max(least, times * p):
                found.setdefault((first, i - first), p)
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def caught(words, **kw):
    c = SquareCatcher(**kw)
    for w in words:
        c.append([w])
    return c.runs()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=70))
def test_two_letters(words):
    assert caught(words) == runs_of(words)
    assert caught(words, min_length=2, min_exponent=2) == runs_of(words, 2, 2)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_powers_side_by_side(parts):
    words = [w for u, k in parts for w in u * k]
    assert caught(words) == runs_of(words)


def test_long_periods_and_fibonacci_words():
    r = random.Random(3)
    for p in (1, 2, 3, 7, 8, 63, 64, 65, 200):
        unit = [str(r.randrange(10 ** 6)) for _ in range(p)]
        words = ["x"] * r.randrange(5) + unit * 5 + unit[:p // 2] + ["y"]
        assert caught(words) == runs_of(words)
    a, b = ["a"], ["a", "b"]
    while len(b) < 1200:
        a, b = b, b + a
    assert caught(b, min_length=2, min_exponent=2) == runs_of(b, 2, 2)
    words = ["a"] * 3000
    assert caught(words) == [(0, 3000, 1)]


def test_runs_can_be_read_between_words():
    c = SquareCatcher()
    c.append("ababab")
    assert c.runs() == []
    c.append("ab")
    assert c.runs() == [(0, 8, 2)]
    c.append("ax")
    assert c.runs() == [(0, 9, 2)]


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        original = list(words)
        for i in range(a, n):
            words[i] = original[a + (i - a) % p]
    runs = runs_of(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join("%d,%d,%d\n" % r for r in runs)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert got == {i: expected(i, t) for i, t in docs if len(t or "") < 30_000} | {
        i: got[i] for i, t in docs if len(t or "") >= 30_000}
    assert any(r[0] for r in got.values())


def test_edge_rows(edge_docs, edge_rows, no_docs):
    got = periodic_runs.with_runs(edge_docs, "found", id_col="doc_id", rewrite=periodic_runs.planted)
    assert got.columns == [*edge_docs.columns, "found"]
    rows = got.select("doc_id", *periodic_runs.summary("found.runs"),
                      F.sha2("found.collapsed", 256).alias("c")).collect()
    assert len(rows) == len(edge_rows)
    short = [(i, t) for i, t, *_ in edge_rows if len(t or "") < 30_000]
    want = sorted((str(i), *expected(i, t)) for i, t in short)
    have = sorted((str(r[0]), *tuple(r)[1:]) for r in rows if r["doc_id"] in {i for i, _ in short})
    assert str(have) == str(want)
    assert periodic_runs.with_runs(no_docs, "found").count() == 0
