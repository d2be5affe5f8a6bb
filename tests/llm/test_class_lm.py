"""The class model: base scores by hand, probabilities that sum to one, exchanges that gain."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
from pyspark.sql import functions as F

from brute import WORD
from vitaldf.llm import class_lm, queries

SF = "/root/testdata/sf0.001"


def tokens_of(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), ""]


def base_scores(rows, trained):
    counts = Counter(t for i, x in rows if trained(i) for t in tokens_of(x))
    n, v = sum(counts.values()), len(counts)
    return [(i, not trained(i), len(w), sum(t in counts for t in w), n,
             sum(log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in w))
            for i, x in rows for w in [tokens_of(x)]]


def by_id(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 != 1


def train():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1


def same_base(got, rows, trained=by_id):
    have = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 6)) for r in got)
    assert have == sorted((str(i), h, n, k, t, round(s, 6)) for i, h, n, k, t, s in base_scores(rows, trained))


def test_base_and_gain_on_the_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_class_lm(spark, SF).collect()
    same_base(got, rows)
    for held_out in (False, True):
        some = [r for r in got if r["held_out"] == held_out]
        assert sum(r["score"] for r in some) > 0.95 * sum(r["base_score"] for r in some)


def grammar(seed, n):
    """Texts of two word kinds that alternate, in two dialects."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        d = "ab"[i % 2]
        out.append((i, " ".join(f"{d}{'xy'[j % 2]}{int(r.paretovariate(0.7)) % 90}" for j in range(r.randrange(5, 60)))))
    return out


def test_blocks_and_partitions_change_nothing_and_classes_help(spark):
    rows = grammar(4, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    runs = [class_lm.lm_scores(docs.repartition(parts), train(), classes=8, frequent=64, block_tokens=size).collect()
            for parts, size in ((1, 1 << 21), (5, 300))]
    one, two = ({r["doc_id"]: r["score"] for r in got} for got in runs)
    assert all(abs(one[i] - two[i]) < 1e-6 for i in one) and len(one) == len(two) == 300
    same_base(runs[1], rows)
    held = [r for r in runs[0] if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)
    assert all(abs(r["perplexity"] - 10 ** (-r["score"] / r["n_tokens"])) < 1e-6 * r["perplexity"] for r in held)


def likelihood(classes, pairs):
    """Of all class bigrams, and of words within classes but for a constant."""
    n, left, right = Counter(), Counter(), Counter()
    for (a, b), c in pairs.items():
        n[classes[a], classes[b]] += c
        left[classes[a]] += c
        right[classes[b]] += c
    return sum(c * np.log(c) for c in n.values()) - sum(c * np.log(c) for x in (left, right) for c in x.values())


def test_an_exchange_gains_most():
    r = random.Random(8)
    text = [r.choice("aabcdefgh") for _ in range(3000)]
    for w in "fgh":
        # a word that never stands beside itself, so that its neighbours keep their classes
        seq = [x for i, x in enumerate(text) if x != w or text[i - 1] != w]
        seq = [0, *("abcdefgh".index(x) + 1 for x in seq), 0]
        classes = {0: 4, 1: 0, 2: 1, 3: 2, 4: 0, 5: 1, 6: 2, 7: 0, 8: 1}
        me, m = "abcdefgh".index(w) + 1, 5
        pairs = Counter(zip(seq, seq[1:]))
        matrix, left, right = np.zeros((m, m), np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
        for (a, b), c in pairs.items():
            matrix[classes[a], classes[b]] += c
            if b == me:
                left[classes[a]] += c
            if a == me:
                right[classes[b]] += c
        # no own neighbours in its class, where a cell changes on both sides
        k = class_lm.best_class(left, right, matrix, matrix.sum(1), classes[me], 3)
        gains = [likelihood(classes | {me: x}, pairs) for x in range(3)]
        assert max(gains) - gains[k] <= 0.05 * (max(gains) - min(gains)) + 1e-9


def test_probabilities_after_a_class_sum_to_one():
    r = np.random.default_rng(1)
    m = 7
    pairs = r.integers(0, 50, (m, m))
    pairs[m - 2] = pairs[:, m - 2] = 0
    once = r.integers(0, 2, (2, m, m))
    once[:, m - 2] = once[:, :, m - 2] = 0
    for counts in ((pairs, *once), np.zeros((3, m, m), np.int64)):
        to = 10 ** class_lm.log_transitions(*counts)
        assert np.allclose(to.sum(1), 1)
        assert (to > 0).all()


def test_edge_rows_empty_tables_and_nothing_to_learn_from(edge_docs, edge_rows, no_docs):
    rows = [(i, t) for i, t, *_ in edge_rows]
    got = class_lm.lm_scores(edge_docs, train())
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
                           "perplexity"]
    got = got.collect()
    same_base(got, rows)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert class_lm.lm_scores(no_docs, train()).count() == 0
    none = class_lm.lm_scores(edge_docs, F.lit(False)).collect()
    same_base(none, rows, lambda i: False)
    assert all(np.isfinite(r["score"]) for r in none)
