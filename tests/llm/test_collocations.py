"""Collocations against a plain count, and the summaries' guarantee."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from vitaldf.llm import collocations
from vitaldf.llm.collocations import Summary, pack_counters, unpack_counters


def counted(rows):
    counts = Counter()
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            for n in (1, 2, 3):
                counts.update((lang or "und", tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    return counts


def ranked(rows, least, top):
    f = counted(rows)
    total = Counter()
    for (lang, words), n in f.items():
        total[lang] += n if len(words) == 1 else 0
    found = {}
    for (lang, words), a in f.items():
        if len(words) == 1 or a < least:
            continue
        if len(words) == 2 and any(n >= least and 100 * n >= 50 * a for (x, w), n in f.items()
                                   if x == lang and len(w) == 3 and words in (w[:2], w[1:])):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return [(lang, i, p.decode(), -a, left, right, total[lang], -s) for lang, x in found.items()
            for i, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=60), max_size=6), st.integers(2, 12))
def test_merged_summaries_keep_every_frequent_key(parts, least):
    true = Counter(x for p in parts for x in p)
    summary = Summary(sum(true.values()) // least + 1)
    for p in parts:
        keys, counts = np.unique(np.array(p, np.uint64), return_counts=True)
        summary.merge(*unpack_counters(pack_counters(keys, counts.astype(np.int64))))
    kept = set(summary.frequent(least).tolist())
    assert {x for x, n in true.items() if n >= least} <= kept
    assert len(summary.keys) <= summary.capacity


def test_a_summary_drops_what_is_rare():
    summary = Summary(1000)
    r = np.random.default_rng(2)
    for _ in range(20):
        keys = np.unique(r.integers(1000, 1 << 40, 400).astype(np.uint64))
        summary.merge(np.concatenate([[7], keys]).astype(np.uint64), np.ones(len(keys) + 1, np.int64))
    assert summary.off > 0 and 7 in summary.frequent(10) and len(summary.frequent(10)) < 1100


def corpus():
    r = random.Random(5)
    pool = [f"w{i}" for i in range(30)]
    texts = []
    for i in range(400):
        words = r.choices(pool, k=r.randrange(0, 60))
        if i % 3 == 0:
            words[:0] = ["New", "York", "city"]
        words = [w + r.choice(["", "", "", ",", ".\n", "\t", " "]) for w in words]
        texts.append((["en", "de", None, "und"][i % 4], " ".join(words)))
    return texts + [("en", None), (None, ""), ("en", " . ,"), ("fr", "only a few words")] + texts[:7] * 5


def test_against_a_plain_count(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(t, g, "x") for g, t in rows], "text string, lang string, part string")
    for size in (collocations._RANGE_BYTES, 2048):  # one range of hashes, and many
        monkeypatch.setattr(collocations, "_RANGE_BYTES", size)
        monkeypatch.setattr(collocations, "_SLICE", size)
        got = [tuple(r) for r in collocations.collocations(docs.repartition(5), top=25).collect()]
        assert sorted(got) == sorted(ranked(rows, 10, 25))


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MAX_FILTER_BITS", 6)
    monkeypatch.setattr(collocations, "_TASK_COUNTERS", 50)
    rows = corpus()[:150]
    docs = spark.createDataFrame([(t, g) for g, t in rows], "text string, lang string")
    got = [tuple(r) for r in collocations.collocations(docs, min_count=4).collect()]
    assert sorted(got) == sorted(ranked(rows, 4, 2000))


def test_edge_rows_and_empty_tables(edge_docs, edge_rows, no_docs):
    got = [tuple(r) for r in collocations.collocations(edge_docs, min_count=60).collect()]
    assert sorted(got) == sorted(ranked([(r[2], r[1]) for r in edge_rows], 60, 2000))
    assert collocations.collocations(no_docs).count() == 0


def test_words_of_a_batch_with_nothing_in_it():
    tokens = collocations.Tokens.of(pa.array(["en", "en"]), pa.array(["", " ,. "]))
    assert len(tokens.code) == 0 and [len(at) for _, at, _ in tokens.keys()] == [0, 0]
