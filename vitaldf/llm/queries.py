"""Registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaldf.llm import (class_lm, collocations, license_scan, mixing, packing, periodic_runs, quality,
                         secret_scan, sharding, simhash, token_files, topk, toxicity)
from vitaldf.llm.common import read_table
from vitaldf.llm.oracle import COLLOCATIONS, LICENSES, MIXING, SECRETS, TOP_K

TOKENIZER = "byte_bpe_50k.json"


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")

    def of(kind):
        return F.filter(spans, lambda s: s["kind"] == kind)

    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(spans).alias("spans"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.col("copy").cast("long").alias("copy"), "shuffle_key")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = token_files.encode_to_files(read_table(spark, sf_dir, "documents"),
                                      public_tokenizers.path(TOKENIZER))
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, counted = toxicity.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.score(model, counted).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", "neighbours", "cosines")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(read_table(spark, sf_dir, "documents"),
                                       public_tokenizers.path(TOKENIZER)))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    return class_lm.lm_scores(read_table(spark, sf_dir, "documents"), train).drop("perplexity")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.with_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "found",
                                    id_col="doc_id", rewrite=periodic_runs.planted)
    return found.select("doc_id", *periodic_runs.summary("found.runs"),
                        F.sha2("found.collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_secrets, op2_licenses, op3_mixing, op4_token_files, op5_toxicity, op6_top_k, op7_sharding,
             op8_quality, op9_simhash, op10_packing, op11_collocations, op12_class_lm, op13_periodic_runs,
             pipeline]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_secrets": SECRETS, "op2_licenses": LICENSES, "op3_mixing": MIXING, "op6_top_k": TOP_K,
            "op11_collocations": COLLOCATIONS}
