"""The corpus pipeline: quality rules, near duplicates, secrets, mixing, packing.

Each stage gets what its predecessor kept, as documents read again from
Parquet in the shared folder, and all but the last return the columns of
documents.  An empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaldf.llm import mixing, packing, quality, secret_scan, simhash
from vitaldf.llm.common import read_table, saved, make_ready

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the compression bands reject."""
    make_ready(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    make_ready(spark)
    return simhash.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars`` follows the text."""
    return secret_scan.mask_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in a global random order."""
    return mixing.mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of equal length in buckets, none across documents."""
    make_ready(spark)
    return packing.digest(packing.pack(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secrets", secrets),
          ("mixing", mix), ("packing", pack)]

#: zstandard, XXH64 and the tokenizer have no DuckDB function; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents`` after all stages."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
