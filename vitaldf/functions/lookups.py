"""Keyword classification and small fixed lookups as Column expressions.

Lookups are literal maps (`element_at(map, key)`), evaluated inside the
generated code of the projection — no join, nothing shipped per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitaldf import schema as S
from vitaldf.functions.text import name_slug  # noqa: F401  (re-export)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(d: Mapping[str, str]) -> Column:
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def lookup(d: Mapping[str, str], key, default=None) -> Column:
    """``d[key]`` with a default (a Column or literal)."""
    hit = F.try_element_at(literal_map(d), _col(key))
    if default is None:
        return hit
    return F.coalesce(hit, default if isinstance(default, Column) else F.lit(default))


def keyword_class(text, rules: Sequence[tuple[str, Sequence[str]]], default) -> Column:
    """First rule whose keywords occur in ``text`` (substring match)."""
    text = _col(text)
    out = None
    for label, words in rules:
        cond = None
        for w in words:
            c = text.contains(w)
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def file_name(path) -> Column:
    """Last path component."""
    return F.substring_index(_col(path), "/", -1)


def base_name(path, ext: str) -> Column:
    """File name without the given extension."""
    return F.regexp_replace(file_name(path), ext.replace(".", r"\.") + "$", "")


# ---- activity-app CSV ------------------------------------------------------

def gyro_sub_type(path) -> Column:
    t = F.regexp_extract(file_name(path), S.GYRO_FILE_PATTERN, 1)
    return F.when(t != "", t).otherwise(F.lit("unknown"))


def gyro_data_type(sub_type) -> Column:
    return lookup(S.GYRO_FILE_TYPES, sub_type, "unknown")


# ---- phone-health XML --------------------------------------------------------

def unit_map_apple(unit) -> Column:
    return F.coalesce(lookup(S.APPLE_UNITS, unit), _col(unit))


def subtype_apple(record_type) -> Column:
    t = _col(record_type)
    return F.coalesce(lookup(S.APPLE_SUBTYPES, t),
                      F.lower(F.replace(t, F.lit(S.APPLE_TYPE_PREFIX), F.lit(""))))


def datatype_apple(record_type) -> Column:
    return lookup(S.APPLE_TYPES, record_type, "unknown")


def confidence_source(source_name) -> Column:
    s = _col(source_name)
    return (F.when(s.contains("Apple Watch") | s.contains("iPhone"), F.lit(0.9))
            .when(s.contains("Health"), F.lit(0.8))
            .otherwise(F.lit(0.7)))


def confidence_service(service) -> Column:
    return F.when(_col(service) == "healthkit", F.lit(0.9)).otherwise(F.lit(0.7))


# ---- habits -------------------------------------------------------------------

def habit_categorize(name) -> Column:
    return keyword_class(F.lower(_col(name)), S.HABIT_CATEGORIES, "other")


# ---- self-tracked CSV ---------------------------------------------------------

def classify_file_manual(path) -> Column:
    return keyword_class(F.lower(file_name(path)), S.MANUAL_TYPES, "general")


def severity_map(sev) -> Column:
    """L/M/H or words -> low/medium/high; other text passes through."""
    return F.coalesce(lookup(S.SEVERITY_WORDS, sev), _col(sev))


def severity_score(sev_word) -> Column:
    return F.coalesce(lookup({k: str(v) for k, v in S.SEVERITY_SCORES.items()}, sev_word)
                      .cast("double"), F.lit(3.0))


def unit_infer_sleep(field_name: str, value) -> Column:
    """Unit from the source column name (plan time) and the value (row level)."""
    f = field_name.lower()
    v = _col(value)
    pct = "percent" in f or "%" in f
    rest = ("hours" if "hour" in f else
            "minutes" if ("minute" in f or "duration" in f or "time" in f) else
            "count" if ("count" in f or "wake" in f) else "units")
    if pct:
        return F.lit("percent")
    return F.when((v <= 1) & (v >= 0), F.lit("percent")).otherwise(F.lit(rest))


def weight_unit(weight) -> Column:
    return F.when(_col(weight) > 50, F.lit("kg")).otherwise(F.lit("lbs"))


# ---- movement app ---------------------------------------------------------------

def classify_file_moves(path) -> Column:
    return lookup(S.MOVES_FILE_TYPES, base_name(path, ".csv"), "mixed")
