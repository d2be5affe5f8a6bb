"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces of MAX_TOKENS and then of the
binary digits of the rest, largest first.  Each piece is a sequence by
itself, so that none crosses documents and none needs padding, and sequences
of equal length are bucketed: their numbers are consecutive, longest bucket
first, and a batch drawn from a bucket is a full rectangle.

Tokenizing tasks count the pieces of each length as they cut; a running sum
over (length, task) gives every sequence its number without moving its ids.

Nulls and edge cases: a null or empty text has the end id alone, one piece of
length 1.  Repeated rows and null ids each keep their own pieces.  Columns
but the id and the text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitaldf.llm.common import saved, text_or_empty
from vitaldf.llm.tokens import text_encoder

MAX_TOKENS = 1024
_BATCH_BYTES = 4 << 20


def piece_lengths(n: int, most: int = MAX_TOKENS) -> list[int]:
    """``n`` as pieces of ``most`` (a power of two) and distinct smaller powers of two."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _cut(batches: Iterator[pa.RecordBatch], path: str, most: int,
         id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    encode, task, ranks = text_encoder(path).documents, TaskContext.get().partitionId(), Counter()
    names = ["id", "start", "length", "ids", "doc_tokens", "task", "rank"]
    types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    rows, held = [], 0
    for b in batches:
        for key, ids in zip(b.column(0).to_pylist(), encode(b.column(1)), strict=True):
            n, at = len(ids) // 4, 0
            for length in piece_lengths(n, most):
                rows.append((key, at, length, ids[4 * at:4 * (at + length)], n, task, ranks[length]))
                ranks[length] += 1
                at += length
            held += len(ids)
            if held >= _BATCH_BYTES:
                yield batch(rows)
                rows, held = [], 0
    if rows:
        yield batch(rows)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per piece: the id, start, length, ids (binary, little-endian unsigned 32-bit),
    doc_tokens, sequence_id and offset."""
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    source = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    id_type = source.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    pieces = saved(source.mapInArrow(
        partial(_cut, path=tokenizer, most=max_tokens, id_type=to_arrow_type(id_type)),
        f"id {id_type.simpleString()}, start long, length long, ids binary, doc_tokens long, "
        "task int, rank long"), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = saved(counts, "piece_counts")
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n"))  # a row for each power of two
    base = buckets.select("length", F.coalesce(F.sum("n").over(
        Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = saved(counts.join(base, "length").select(
        "length", "task", (F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("first")),
        "piece_firsts")
    return pieces.join(firsts, ["length", "task"]).select(
        F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens",
        (F.col("first") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def digest(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` with the CRC-32 of the ids in their place."""
    return pieces.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
