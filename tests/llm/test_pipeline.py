"""The pipeline against a plain version of all its stages, and the registered queries' columns."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
import zstandard

import brute
import corpus_pipeline
from vitaldf.llm import mixing, packing, quality, queries, secret_scan

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(text):
    n_words, _, _, _, repeated = brute.quality_counts(text)
    if n_words < 50 or 100 * repeated > 50 * n_words:
        return False
    raw, coder = text.encode(), zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False)
    size = len(coder.compress(raw))
    low, high = next((lo, hi) for below, lo, hi in quality.BANDS if below is None or len(raw) < below)
    if not low * size <= len(raw) <= high * size:
        return False
    step = quality.CHUNK_BYTES
    chunks = [raw[i:i + step] for i in range(0, len(raw) - step + 1, step)] if len(raw) > step else []
    sizes = [len(coder.compress(c)) for c in chunks]
    bad = sum(step < quality.CHUNK_BAND[0] * s or step > quality.CHUNK_BAND[1] * s for s in sizes)
    return bad <= len(chunks) * quality.MAX_BAD_CHUNKS


def masked(text):
    spans = [(s, e) for s, _, _, e in brute.base_spans(text)]
    for r in secret_scan.RULES:
        if r.kind not in secret_scan.BASE_KINDS:
            spans += [m.span() for m in re.finditer(r.regex, text)]
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], "[SECRET]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def copies(rows):
    size = Counter()
    for r in rows:
        size[r["source"]] += len(r["text"].encode())
    weight = {s: n ** mixing.ALPHA for s, n in size.items()}
    for r in rows:
        s = r["source"]
        rate = weight[s] / sum(weight.values()) * sum(size.values()) / size[s]
        who = hashlib.md5(f"{mixing.SEED}:{r['doc_id']}:{hashlib.md5(r['text'].encode()).hexdigest()}"
                          .encode()).hexdigest()
        u = (int(who[:13], 16) + 0.5) / 16 ** 13
        n, p = 0, math.exp(-rate)
        total = p
        while total < u:
            n += 1
            p *= rate / n
            total += p
        yield r, n


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_pipeline_equals_its_plain_version(spark, docs):
    rows = [r.asDict() for r in docs.orderBy("doc_id").collect() if good(r["text"])]
    first = brute.groups([brute.fingerprint(r["text"]) for r in rows])
    rows = [r for i, r in enumerate(rows) if first[i] == i]
    for r in rows:
        r["text"] = masked(r["text"])
    want = Counter()
    kept = [(r, n) for r, n in copies(rows) if n]
    for (r, n), ids in zip(kept, brute.token_ids([r["text"] for r, _ in kept]), strict=True):
        at = 0
        for length in packing.piece_lengths(len(ids)):
            want[(r["doc_id"], at, length, brute.crc(ids[at:at + length]), len(ids))] += n
            at += length
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out) == want
    assert sorted(r["sequence_id"] for r in out) == list(range(len(out)))


def test_stages_keep_the_columns_of_documents(spark, edge_docs, no_docs):
    for table in (edge_docs.select(*COLUMNS), no_docs.select(*COLUMNS)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, SF)
            assert table.columns == COLUMNS, name
        assert set(corpus_pipeline.STAGES[-1][1](spark, table, SF).columns) >= {"doc_id", "sequence_id"}


def test_clean_documents_stay(spark):
    rows = [(i, brute.prose(i, 80 + i), "en", "s", 0) for i in range(60)]
    table = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(
        COLUMNS, ["long", "string", "string", "string", "long"], strict=True)))
    for _, stage in corpus_pipeline.STAGES[:3]:
        table = stage(spark, table, SF)
    assert {(r["doc_id"], r["text"]) for r in table.collect()} == {(r[0], r[1]) for r in rows}


CONTRACTS = {
    "op1_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4_token_files": "doc_id start n_tokens ids_crc32",
    "op5_toxicity": "doc_id held_out score predicted",
    "op6_top_k": "query_id rank vec_id score",
    "op7_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op8_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_simhash": "doc_id fingerprint component_id",
    "op10_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset"}


def test_token_query_results(spark, docs):
    rows = docs.orderBy("doc_id").collect()
    ids = brute.token_ids([r["text"] for r in rows])
    got = {r["doc_id"]: r for r in queries.op4_token_files(spark, SF).collect()}
    starts = np.cumsum([0, *map(len, ids)])
    assert [(got[r["doc_id"]]["start"], got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["ids_crc32"]) for r in rows] == [
        (int(s), len(x), brute.crc(x)) for s, x in zip(starts, ids, strict=False)]


def test_secret_query_results(spark, docs):
    got = {r["doc_id"]: r for r in queries.op1_secrets(spark, SF).collect()}
    for r in docs.collect():
        kinds = Counter(k for _, _, k, _ in brute.base_spans(r["text"]))
        x = got[r["doc_id"]]
        assert (x["n_assign"], x["n_access"], x["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert x["base_sha256"] == brute.base_digest(r["text"])


def test_toxicity_query_finds_held_out_labels(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = queries.op5_toxicity(spark, SF).collect()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    flagged = [labels[r["doc_id"]] for r in out if r["predicted"] and r["doc_id"] in labels]
    assert all(flagged)


def test_query_columns(spark):
    for name in ("op7_sharding", "op8_quality", "op9_simhash", "op10_packing", "op5_toxicity"):
        assert queries.queries()[name](spark, SF).columns[:len(CONTRACTS[name].split())] == CONTRACTS[name].split()
