"""Pre-record assembly, occurrence ordinals, timestamp parsing, ids, rejects.

Every source normaliser ends in :func:`pre_record` columns; :func:`finalize`
turns them into health records (valid rows) or rejects (reason set) in one
projection, so the caller decides whether one or both are materialised.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitaldf.functions import (blank_to_null, json_raw, may_be_of_days, metric_map, null_location,
                               string_map, ts_now, ts_parse)
from vitaldf.functions.metrics import typed_map
from vitaldf.functions.timestamps import ts_parse_sql
from vitaldf.schema import PRE_RECORD, RECORD, REJECT

META_COLS = ("origin", "occurrence")
ID_SEP = "\u001f"
COPIES_AT_ONCE = 1 << 14
#: row hashes sent to every task, 8 bytes each
MAX_REPEATED = 1 << 16
#: rows are numbered in place if at most one in so many has a copy
MOSTLY_ALONE = 100


def header_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META_COLS and c != "raw_data"]


def with_occurrence(raw: DataFrame) -> DataFrame:
    """Number identical raw rows of one origin 1..k (bag semantics, stable ids).

    A window over the whole rows, sorted by their hash.  Only the record id
    reads the number: a query that does not read ids drops the window, with
    its shuffle and sort, by column pruning.  No job runs when the plan is
    built.  Copies of one row meet in one task, which streams them (the window
    spills, and holds no group in memory).
    """
    if "occurrence" in raw.columns:
        return raw
    row = F.xxhash64(*raw_cols(raw))
    copies = Window.partitionBy("__row", *raw_cols(raw)).orderBy("__row")
    return raw.withColumn("__row", row).select(
        *raw_cols(raw), F.row_number().over(copies).cast("bigint").alias("occurrence"))


def numbered_in_place(raw: DataFrame) -> DataFrame:
    """``raw`` with ``occurrence``, where all ids are wanted and copies are few.

    Only hashes of the rows are shuffled: those seen twice or more are few,
    and a row with another hash has no copy and keeps its place as number 1.
    The rest (all rows, where more than 1 in MOSTLY_ALONE is a copy) are
    counted and regenerated by :func:`numbered_copies`.  Equal hashes of
    different rows send them there too, which changes no number.

    The hashes are counted when the plan is built, by one job over ``raw``.
    """
    spark = raw.sparkSession
    row = F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns])
    rows = Observation()
    found = (raw.select(row.alias("__row")).observe(rows, F.count(F.lit(1)).alias("n"))
             .groupBy("__row").agg(F.count(F.lit(1)).alias("__copies"))
             .filter(F.col("__copies") > 1).limit(MAX_REPEATED + 1).collect())
    alone = F.lit(1).cast("bigint").alias("occurrence")
    if not found:
        return raw.select("*", alone)
    if len(found) > MAX_REPEATED or MOSTLY_ALONE * sum(r["__copies"] for r in found) > rows.get["n"]:
        return numbered_copies(raw)
    repeated = F.broadcast(spark.createDataFrame([(r["__row"],) for r in found], "__row bigint"))
    hashed = raw.withColumn("__row", row)
    return hashed.join(repeated, "__row", "left_anti").select(*raw_cols(raw), alone).unionByName(
        numbered_copies(hashed.join(repeated, "__row", "left_semi").select(*raw_cols(raw))))


def raw_cols(raw: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in raw.columns]


def numbered_copies(raw: DataFrame) -> DataFrame:
    """``raw`` with ``occurrence``, by a whole-row shuffle.

    Identical rows are counted with a hash aggregate whose partial
    (map-side) step collapses a hot duplicate before the shuffle, then the
    copies are regenerated, COPIES_AT_ONCE at a time.  No group is ever
    buffered, however many copies it holds.
    """
    keys = raw_cols(raw)
    counted = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies"))
    first = F.sequence(F.lit(1).cast("bigint"), F.col("__copies"), F.lit(COPIES_AT_ONCE))
    return counted.select(*keys, "__copies", F.explode(first).alias("__first")).select(
        *keys, F.explode(F.sequence("__first", F.least(
            "__copies", F.col("__first") + (COPIES_AT_ONCE - 1)))).alias("occurrence"))


def with_raw_json(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = header_cols(df) if cols is None else list(cols)
    return df.withColumn("raw_data", json_raw(cols))


def pre_record(source, data_type, sub_type, ts_text: Column,
               metrics: Mapping[str, Column] | None = None,
               attrs: Mapping[str, Column] | None = None,
               times: Mapping[str, Column] | None = None,
               symptoms: Column | None = None,
               loc: Column | None = None,
               raw: Column | None = None,
               problem: Column | None = None) -> list[Column]:
    """``problem``: why the row must be rejected, whatever its timestamp."""
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)
    return [
        F.col("origin").cast("string").alias("origin"),
        F.col("occurrence").cast("bigint").alias("occurrence"),
        lit(source).cast("string").alias("source"),
        lit(data_type).cast("string").alias("data_type"),
        lit(sub_type).cast("string").alias("sub_type"),
        ts_text.cast("string").alias("ts_text"),
        metric_map(metrics or {}).alias("metrics"),
        string_map(attrs or {}).alias("attrs"),
        # blank text is left out; parsed once in finalize
        string_map({k: blank_to_null(v) for k, v in (times or {}).items()}).alias("times_text"),
        (symptoms if symptoms is not None
         else F.lit(None).cast("array<string>")).alias("symptoms"),
        (loc if loc is not None else null_location()).alias("location"),
        (raw if raw is not None else F.col("raw_data")).cast("string").alias("raw_data"),
        lit(problem).cast("string").alias("problem"),
    ]


def _times_cols(times: Mapping[str, Column]) -> list[Column]:
    """Parsed time fields as a map, and whether any held non-timestamp text.

    Each field is parsed by one expression shared by both columns (common
    subexpression elimination evaluates it once per row).
    """
    parsed = {k: ts_parse(v) for k, v in times.items()}
    bad = F.lit(False)
    for k, v in times.items():
        bad = bad | F.coalesce(blank_to_null(v).isNotNull() & parsed[k].isNull(), F.lit(False))
    return [typed_map(parsed, "timestamp").alias("times"), bad.alias("bad_time")]


def empty_pre_records(spark) -> DataFrame:
    return spark.createDataFrame([], PRE_RECORD)


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name (no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def record_id(source, origin, sub_type, ts_text, raw_data, occurrence) -> Column:
    """Deterministic record id: same raw row of the same file -> same id."""
    return F.sha2(F.concat_ws(ID_SEP, source, origin, sub_type, ts_text, raw_data,
                              occurrence.cast("string")), 256)


def finalize(pre: DataFrame) -> DataFrame:
    """Parse timestamps, assign ids, and set ``reason`` for rows to reject.

    Output = RECORD columns + ``ts_text`` + ``reason`` (NULL for valid rows).
    """
    # parse once, in its own projection (built as SQL text: one call into
    # the JVM for the whole parser); everything below reads the results
    parsed = pre.withColumns({
        "__ts": ts_parse("ts_text"),
        "__times": F.expr(f"transform_values(times_text, (k, v) -> {ts_parse_sql('v')})"),
    })
    ts = F.col("__ts")
    # a time field holding text that is not a timestamp rejects the row
    bad_time = F.expr("exists(map_values(__times), x -> x IS NULL)")
    reason = (F.when(F.col("problem").isNotNull(), F.col("problem"))
              .when(blank_to_null(F.col("ts_text")).isNull(),
                    F.lit("Missing required field: timestamp"))
              .when(ts.isNull(), F.concat(F.lit("Unable to parse date: "), F.col("ts_text")))
              .when(F.coalesce(bad_time, F.lit(False)),
                    F.lit("Unable to parse date in time field")))
    # a generator makes what was parsed from text: a filter on it stays above
    # (pushed below, it would copy the whole parse into each predicate), while
    # filters on source and type go below, down to the layouts that they leave
    made = parsed.select(*pre.columns, F.inline(F.array(F.struct(
        ts.alias("timestamp"), F.col("__times").alias("times"), reason.alias("reason")))))
    return made.select(
        record_id(F.col("source"), F.col("origin"), F.col("sub_type"), F.col("ts_text"),
                  F.col("raw_data"), F.col("occurrence")).alias("id"),
        "timestamp",
        F.to_date("timestamp").alias("date_only"),
        "source", "data_type", "sub_type",
        ts_now().alias("processed_at"),
        "metrics", "attrs", "times",
        "symptoms", "location", "raw_data", "origin", "ts_text", "reason",
    )


def valid(finalized: DataFrame) -> DataFrame:
    return finalized.filter(F.col("reason").isNull()).select(*RECORD.fieldNames())


def rejects(finalized: DataFrame) -> DataFrame:
    return finalized.filter(F.col("reason").isNotNull()).select(*REJECT.fieldNames())


def of_days(finalized: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Finalised rows of these days.

    The timestamps' texts tell most others first: that filter goes below the
    numbering of copies, which then shuffles few rows, and below what makes
    the other columns.
    """
    return finalized.filter(may_be_of_days("ts_text", start, end)).filter(
        F.col("date_only").between(F.lit(start), F.lit(end)))


def build_records(pre: DataFrame) -> DataFrame:
    return valid(finalize(pre))


def filter_required(df: DataFrame, fields: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Keep rows whose required fields are present and non-empty."""
    cond = F.lit(True)
    for f in fields:
        c = F.col(f)
        cond = cond & c.isNotNull() & (c.cast("string") != "")
    return df.filter(cond)


def filter_blank_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose every header field is blank."""
    cols = header_cols(df) if cols is None else list(cols)
    if not cols:
        return df
    return df.filter(F.coalesce(*[blank_to_null(F.col(f"`{c}`")) for c in cols]).isNotNull())
