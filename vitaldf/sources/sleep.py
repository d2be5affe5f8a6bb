"""Sleep-tracker CSV files: delimiter and layout are detected per file header.

The layout decision is header-level, so it is made at plan time from the
DataFrame's columns (one read per header signature, see `sources.files`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaldf import functions as V
from vitaldf.operators.records import (filter_blank_rows, header_cols, pre_record,
                                       with_occurrence, with_raw_json)
from vitaldf.schema import SLEEP_DETAILED_FIELDS, SLEEP_DETAILED_TS

SOURCE = "sleep_tracker"


def detect_delimiter(sample: str) -> str:
    """';' when the sample holds more ';' than ','."""
    return ";" if sample.count(";") > sample.count(",") else ","


def detect_format(header: str) -> str:
    """Layout from the header line.

    Headers naming `bedtime`/`sleep_start` are the detailed layout; they are
    tested first because such headers also contain "start" and "end".
    """
    h = header.lower()
    if "bedtime" in h or "sleep_start" in h:
        return "detailed"
    if "start" in h and "end" in h:
        return "quality" if "quality" in h else "simple"
    return "unknown"


def classify_sleep_format(first_line) -> F.Column:
    """Column twin of :func:`detect_format` over a header-line column."""
    h = F.lower(first_line)
    return (F.when(h.contains("bedtime") | h.contains("sleep_start"), "detailed")
            .when(h.contains("start") & h.contains("end"),
                  F.when(h.contains("quality"), "quality").otherwise("simple"))
            .otherwise("unknown"))


def normalize(raw: DataFrame, fmt: str | None = None) -> DataFrame:
    cols = header_cols(raw)
    fmt = fmt or detect_format(",".join(cols))
    df = with_raw_json(with_occurrence(filter_blank_rows(raw, cols)), cols)

    def c(name):
        return V.col_or_null(cols, name)

    def first(names):
        return V.first_present_column(cols, names)

    if fmt in ("quality", "simple"):
        start_f = first(["start", "Start"] if fmt == "quality" else ["start_time", "start", "Start"])
        end_f = first(["end", "End"] if fmt == "quality" else ["end_time", "end", "End"])
        if start_f is None or end_f is None:
            return df.limit(0).select(*pre_record(SOURCE, "sleep", "sleep_session", F.lit(None)))
        start, end = c(start_f), c(end_f)
        metrics = {"sleep_duration": V.metric(V.duration_minutes(start_f, end_f), "minutes", 0.8)}
        attrs = {}
        if fmt == "quality":
            q = V.blank_to_null(c(first(["Sleep quality", "quality", "Quality"])))
            qv = V.pct_parse(q)
            metrics["sleep_quality"] = V.metric_when(qv.isNotNull(), qv, "percent", 0.7)
            bed = V.blank_to_null(c(first(["Time in bed", "time_in_bed", "bedtime"])))
            bv = V.duration_hm_minutes(bed)
            metrics["time_in_bed"] = V.metric_when(bed.isNotNull() & (bv > 0), bv, "minutes", 0.8)
            attrs["wake_mood"] = V.blank_to_null(c(first(["Wake up", "wake_up", "wake_mood"])))
            attrs["sleep_notes"] = V.blank_to_null(c(first(["Sleep Notes", "notes", "Notes"])))
        else:
            attrs["measurement_source"] = V.blank_to_null(c(first(["service", "source", "Service"])))
        times = {"sleep_start": start, "sleep_end": end}
        return df.select(*pre_record(SOURCE, "sleep", "sleep_session", start, metrics, attrs, times))

    if fmt == "detailed":
        ts_f = first(SLEEP_DETAILED_TS)
        if ts_f is None:
            return df.limit(0).select(*pre_record(SOURCE, "sleep", "detailed_sleep", F.lit(None)))
        metrics = {}
        for name, aliases in SLEEP_DETAILED_FIELDS.items():
            f = first(aliases)
            if f is None:
                continue
            v = V.strip_parse(c(f))
            metrics[name] = V.metric_when(v.isNotNull(), v, V.unit_infer_sleep(f, v), 0.8)
        return df.select(*pre_record(SOURCE, "sleep", "detailed_sleep", c(ts_f), metrics))

    # unknown layout: any date/time/start column + every numeric field
    ts_f = V.first_matching_column(cols, ["date", "time", "start"])
    if ts_f is None:
        return df.limit(0).select(*pre_record(SOURCE, "sleep", "generic_sleep", F.lit(None)))
    df = df.filter(V.blank_to_null(c(ts_f)).isNotNull())
    return df.select(*pre_record(SOURCE, "sleep", "generic_sleep", c(ts_f),
                                 fields_to_metrics(cols, exclude=ts_f, confidence=0.6,
                                                   unit_fn=V.unit_infer_sleep)))


def fields_to_metrics(cols, exclude: str | None, confidence: float, unit_fn=None,
                      unit: str = "units") -> dict:
    """Every numeric header field as a metric under its slugged name.

    Slug collisions are resolved at plan time: the later column wins.
    """
    out = {}
    for name in cols:
        if name == exclude:
            continue
        v = V.strip_parse(F.col(f"`{name}`"))
        u = unit_fn(name, v) if unit_fn else F.lit(unit)
        key = V.slug(name)
        out.pop(key, None)
        out[key] = V.metric_when(v.isNotNull(), v, u, confidence)
    return out
