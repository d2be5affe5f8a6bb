"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the output over its share
of the input.  Each document's count is the inverse of the Poisson
distribution with that mean at a uniform number hashed from seed and
document, so a rerun gives the same counts.  A document is exploded by its
count and the copies are shuffled globally by another hash.

All of it is DataFrame functions.  Sources are summed up before any shuffle;
the rates are one row a source, which Spark broadcasts only if their size is
small, and a document of a hot source needs no other of it.

Nulls and edge cases: a null source is a source of its own; a null text has
no bytes (a source without any keeps each document once).  Documents are
told apart by id and text; a repeated row draws the count of its twin.  An
empty table gives an empty one.  A source that ``weights`` leaves out has
weight zero.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaldf.llm.common import free_name, saved, text_or_empty

SEED = 42
#: without weights: target share in proportion to bytes ** ALPHA
ALPHA = 0.5
#: hashes give this many hexadecimal digits, exact in a double
_DIGITS = 13
#: rates below this have a table from count 0 on
FROM_ZERO = 1000
STRIDE = 64


def uniform(digest: Column) -> Column:
    """A number in (0, 1) from the first digits of an MD5."""
    return (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** _DIGITS)


def poisson_first(rate: Column) -> Column:
    """The first count of the table: 0, or for large rates one that hardly any smaller count is drawn below."""
    return F.when(rate < FROM_ZERO, 0).otherwise(F.floor(rate - 12 * F.sqrt(rate) - 30)).cast("int")


def poisson_cdf(rate: Column) -> Column:
    """Array of P(count <= first), P(count <= first + 1), ... far into the tail.

    Terms are powers of e of logarithms, so that a large rate doesn't
    underflow; a factorial's is a running sum from 0, and Stirling's series
    from FROM_ZERO on.  Sums are added up STRIDE terms at a time, which takes
    linear time.  The table's length grows with the square root of the rate.
    """
    first, last = poisson_first(rate), F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    n = F.greatest(first.cast("double"), F.lit(1.0))
    stirling = (n * F.ln(n) - n + 0.5 * F.ln(2 * pi * n) + 1 / (12 * n) - 1 / (360 * n * n * n))
    start = -rate + F.when(first > 0, n * F.ln(rate) - stirling).otherwise(0.0)
    none = F.array().cast("array<double>")

    def state(log_p, total, cdf):
        return F.struct(log_p.alias("log_p"), total.alias("sum"), cdf.alias("cdf"))

    def step(acc, i):
        log_p = acc["log_p"] + F.ln(rate / i)
        total = acc["sum"] + F.exp(log_p)
        return state(log_p, total, F.concat(acc["cdf"], F.array(total)))

    def stride(acc, i):
        until = F.least(i + (STRIDE - 1), last)
        part = F.aggregate(F.sequence(i, until), state(acc["log_p"], acc["sum"], none), step)
        return F.struct(part["log_p"].alias("log_p"), part["sum"].alias("sum"),
                        F.concat(acc["cdfs"], F.array(part["cdf"])).alias("cdfs"))

    begin = F.struct(start.alias("log_p"), F.exp(start).alias("sum"), F.array(F.array(F.exp(start))).alias("cdfs"))
    cdf = F.aggregate(F.sequence(first + 1, last, F.lit(STRIDE)), begin, stride, lambda a: F.flatten(a["cdfs"]))
    return F.when(rate > 0, cdf).otherwise(F.array(F.lit(1.0)))


def numbers_below(sorted_numbers: Column, u: Column) -> Column:
    """How many of ``sorted_numbers`` are less than ``u``, by binary search."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(sorted_numbers) + 1)).cast("int"))
    begin = F.struct(F.lit(0).alias("low"), F.size(sorted_numbers).alias("high"))

    def halve(acc, _):
        mid = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        done = acc["low"] >= acc["high"]
        less = F.get(sorted_numbers, mid) < u
        return F.struct(F.when(~done & less, mid + 1).otherwise(acc["low"]).alias("low"),
                        F.when(~done & ~less, mid).otherwise(acc["high"]).alias("high"))

    return F.aggregate(steps, begin, halve, lambda a: a["low"])


def rates(docs: DataFrame, source_col: str = "source", text_col: str = "text",
          weights: Mapping[str, float] | None = None, alpha: float = ALPHA,
          epochs: float = 1.0) -> DataFrame:
    """(source, bytes, rate): mean copies of each document of a source.

    ``epochs`` is the bytes of the output over those of the input.
    """
    sums = (docs.groupBy(F.col(f"`{source_col}`").cast("string").alias("source"))
            .agg(F.sum(F.octet_length(text_or_empty(text_col))).cast("double").alias("bytes")))
    if weights is None:
        weight = F.pow("bytes", F.lit(float(alpha)))
    else:
        given = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else None
        weight = F.lit(0.0) if given is None else F.coalesce(
            F.try_element_at(given, "source").cast("double"), F.lit(0.0))
    sums = saved(sums.withColumn("weight", weight), "source_sums")
    all_bytes, all_weight = sums.agg(F.sum("bytes"), F.sum("weight")).first()
    if not all_bytes or not all_weight:
        rate = F.when(F.col("bytes") == 0, 1.0).otherwise(0.0)
    else:
        rate = F.when(F.col("bytes") == 0, 1.0).otherwise(
            F.col("weight") / F.lit(all_weight) * F.lit(all_bytes) * F.lit(float(epochs)) / F.col("bytes"))
    return sums.select("source", "bytes", rate.alias("rate"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: Mapping[str, float] | None = None, alpha: float = ALPHA, epochs: float = 1.0,
        seed: int = SEED, copy_col: str = "copy", order_col: str = "shuffle_key") -> DataFrame:
    """``docs``, each as often as its Poisson count, in a global random order.

    Adds ``copy_col`` (from 0) and ``order_col``, by which the rows are
    range-partitioned and sorted.
    """
    cdf, low, n, source = (free_name(docs, x) for x in ("cdf", "low", "n", "mixed_source"))
    per_source = rates(docs, source_col, text_col, weights, alpha, epochs).select(
        F.col("source").alias(source), poisson_cdf(F.col("rate")).alias(cdf), poisson_first(F.col("rate")).alias(low))
    # made before the join, so that each text is hashed once
    who, known = free_name(docs, "who"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    marked = docs.withColumn(who, F.md5(F.concat_ws(":", F.lit(str(seed)), known, F.md5(text_or_empty(text_col)))))
    matched = marked.join(per_source, F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(source)))
    # the number is bound by the outer lambda and so made once a row, not once an array element
    count = F.col(low) + F.transform(F.array(uniform(F.col(who))), lambda u: numbers_below(F.col(cdf), u))[0]
    copies = matched.withColumn(n, count).where(F.col(n) > 0).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in (copy_col, order_col)], who,
        F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(copy_col))
    return (copies.withColumn(order_col, F.md5(F.concat_ws(":", who, F.col(copy_col).cast("string"))))
            .drop(who).repartitionByRange(order_col).sortWithinPartitions(order_col))
