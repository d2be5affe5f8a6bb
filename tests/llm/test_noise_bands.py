"""Noise of each kind is rejected where the ratio tells it apart, prose is kept, and a text's end counts."""

from __future__ import annotations

import random
import string

import pytest

from brute import prose
from vitaldf.llm import quality

ALPHABETS = {"base64": string.ascii_letters + string.digits + "+/", "letters": string.ascii_lowercase,
             "hex": "0123456789abcdef"}


def noise(kind: str, n: int, seed: int = 1) -> str:
    r, out = random.Random(seed), ""
    while len(out) < n:
        out += "".join(r.choice(ALPHABETS[kind]) for _ in range(r.randint(4, 9))) + " "
    return out[:n - 1] + "x"


def kept(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["kept"] for r in quality.quality(rows).orderBy("doc_id").collect()]


@pytest.mark.parametrize("kind, least", [("base64", 400), ("letters", 1024), ("hex", 2048)])
def test_noise_is_rejected(spark, kind, least):
    sizes = [n for n in (400, 500, 600, 767, 900, 1023, 1024, 1200, 1535, 1800, 2047, 2048, 3000, 3071, 4000, 4095,
                         4096, 5000, 6143, 8000, 16383, 20000, 70000) if n >= least]
    assert not any(kept(spark, [noise(kind, n, s) for n in sizes for s in range(3)]))


def test_prose_is_kept(spark):
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = [r for r in quality.quality(rows).where("not base_failed").collect()]
    assert sum(r["kept"] for r in found) >= 0.98 * len(found)


@pytest.mark.parametrize("kind", ALPHABETS)
def test_the_end_of_a_text_is_measured(spark, kind):
    start = prose(5, 3000)[:4096]
    assert kept(spark, [start + prose(6, 3000)[:4000]]) == [True]
    assert not any(kept(spark, [start + " " + noise(kind, 4094, s) for s in range(4)]))
