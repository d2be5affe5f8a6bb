"""Texts are taken in slices of bounded size, and summed keys are held once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from vitaldf.llm import collocations as C


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts), pa.string()), pa.array(texts, pa.string())], ["lang", "text"])


def test_batches_are_cut_by_bytes_and_stay_whole():
    texts = ["", "a b", "x" * 50, "", "é" * 10, "c d e", "y" * 9, ""]
    cut = list(C._slices(iter([batch(texts), batch([])]), 20))
    assert len(cut) > 2 and [t for b in cut for t in b.column(1).to_pylist()] == texts
    assert all(sum(len(t.encode()) for t in b.column(1).to_pylist()) <= 20 + 50 for b in cut)


def test_slices_give_the_same_keys():
    texts = [f"one two three {i % 3} one two. four" for i in range(40)]

    def keys(batches):
        return sorted(int(x) for b in batches for _, _, k in C.Tokens.of(b.column(0), b.column(1)).keys() for x in k)
    assert keys(C._slices(iter([batch(texts)]), 64)) == keys([batch(texts)])


def test_sums_hold_no_key_twice():
    keys = [np.array([3, 1], np.uint64), np.array([1], np.uint64)]
    counts = [np.array([2, 5]), np.array([7])]
    k, c = C.summed(keys, counts)
    assert k.tolist() == [1, 3] and c.tolist() == [12, 2] and keys == [] == counts
    assert len(C.summed([np.zeros(0, np.uint64)], [np.zeros(0, np.int64)])[0]) == 0
