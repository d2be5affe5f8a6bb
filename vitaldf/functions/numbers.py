"""Number parsing with the exports' loose text semantics.

``int_prefix`` / ``float_prefix`` read the numeric *prefix* of a text
("12.5abc" -> 12 / 12.5) and give NULL where no number starts the text;
NULL plays the role of "not a number" throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_PREFIX = r"^\s*([+-]?\d+)"
_FLOAT_PREFIX = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _prefix(c, start: str, pattern: str, to: str) -> Column:
    """Only text with a number at its start is cast: a failed cast costs an exception per row."""
    text = _col(c).cast("string")
    return F.when(text.rlike(start), F.regexp_extract(text, pattern, 1).try_cast(to))


def int_prefix(c) -> Column:
    return _prefix(c, r"^\s*[+-]?\d", _INT_PREFIX, "bigint").cast("double")


def float_prefix(c) -> Column:
    return _prefix(c, r"^\s*[+-]?\.?\d", _FLOAT_PREFIX, "double")


def strip_parse(c) -> Column:
    """Drop every character but digits, '.', '-', then read the numeric prefix."""
    c = _col(c)
    return F.when(c != "", float_prefix(F.regexp_replace(c, r"[^0-9.\-]", "")))


def pct_parse(c) -> Column:
    """'75%' -> 75.0"""
    return float_prefix(F.replace(_col(c), F.lit("%"), F.lit("")))


def or_default(v, default) -> Column:
    """``v || default`` for numbers: NULL (not a number) and 0 fall back."""
    v = _col(v)
    return F.when(v.isNull() | (v == 0), F.lit(default)).otherwise(v)


def duration_hms_minutes(c) -> Column:
    """'H:MM:SS.mmm' -> fractional minutes; 0 when fewer than three parts."""
    parts = F.split(_col(c), ":")
    value = (int_prefix(parts.getItem(0)) * 60 + int_prefix(parts.getItem(1))
             + float_prefix(parts.getItem(2)) / 60)
    return F.when(F.size(parts) >= 3, value).otherwise(F.lit(0.0))


def duration_hm_minutes(c) -> Column:
    """'H:MM' -> minutes; a plain number -> itself; otherwise 0."""
    c = _col(c)
    parts = F.split(c, ":")
    hm = int_prefix(parts.getItem(0)) * 60 + int_prefix(parts.getItem(1))
    return F.when(c.contains(":"), hm).otherwise(or_default(float_prefix(c), 0.0))
