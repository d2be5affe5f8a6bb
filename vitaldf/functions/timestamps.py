"""Date / time Column expressions (all JVM-side, no UDFs)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitaldf.schema import DATE_OUTPUT_FORMAT, TS_FORMATS, TS_OUTPUT_FORMAT

_WEEKDAY_FORMAT = "EEE MMM dd HH:mm:ss yyyy"
_WEEKDAY_SHAPE = r"^[A-Z][a-z]{2} [A-Z][a-z]{2} \d{2} \d{2}:\d{2}:\d{2} \d{4}$"
# Offsets written "+08:00" need the ISO pattern letter in addition to "Z".
_COLON_OFFSET_FORMATS = ["yyyy-MM-dd HH:mm XXX", "yyyy-MM-dd HH:mm:ss XXX"]
_D, _T = r"\d{4}-\d{2}-\d{2}", r"\d{2}:\d{2}:\d{2}"
_SHAPES = {
    "yyyy-MM-dd HH:mm:ss": rf"^{_D} {_T}$",
    "yyyy-MM-dd-HH:mm:ss": rf"^{_D}-{_T}$",
    "yyyy-MM-dd": rf"^{_D}$",
    "MM/dd/yyyy HH:mm:ss": rf"^\d{{2}}/\d{{2}}/\d{{4}} {_T}$",
    "MM/dd/yyyy": r"^\d{2}/\d{2}/\d{4}$",
    "yyyy-MM-dd HH:mm Z": rf"^{_D} \d{{2}}:\d{{2}} [+-]\d{{4}}$",
    "yyyy-MM-dd HH:mm:ss Z": rf"^{_D} {_T} [+-]\d{{4}}$",
    "yyyy-MM-dd HH:mm:ss.SSS": rf"^{_D} {_T}\.\d{{3}}$",
    "yyyy-MM-dd HH:mm XXX": rf"^{_D} \d{{2}}:\d{{2}} (Z|[+-]\d{{2}}:\d{{2}})$",
    "yyyy-MM-dd HH:mm:ss XXX": rf"^{_D} {_T} (Z|[+-]\d{{2}}:\d{{2}})$",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """'' / whitespace-only / NULL -> NULL (the 'falsy string' of the exports)."""
    c = _col(c)
    return F.when(F.trim(c) != "", c)


def _sql_lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ts_parse_sql(x: str) -> str:
    """SQL text of :func:`ts_parse` over the SQL expression ``x``."""
    whens = []
    for fmt in TS_FORMATS + _COLON_OFFSET_FORMATS:
        if fmt == _WEEKDAY_FORMAT:
            whens.append(f"WHEN {x} RLIKE {_sql_lit(_WEEKDAY_SHAPE)} THEN try_to_timestamp("
                         f"regexp_replace({x}, {_sql_lit('^[A-Z][a-z]{2} ')}, ''), "
                         f"'MMM dd HH:mm:ss yyyy')")
        else:
            whens.append(f"WHEN {x} RLIKE {_sql_lit(_SHAPES[fmt])} THEN try_to_timestamp({x}, '{fmt}')")
    return (f"date_trunc('second', CASE WHEN {x} IS NULL OR trim({x}) = '' THEN NULL "
            + " ".join(whens) + f" ELSE try_cast({x} AS TIMESTAMP) END)")


def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def ts_parse(c) -> Column:
    """Parse export timestamp text; NULL when empty or unparseable.

    Pass a column *name* where possible: the expression is then built as
    one SQL text (one call into the JVM instead of dozens).

    Strict formats first (mutually exclusive, so order is irrelevant), then a
    lenient ISO-8601 cast.  Offsets are converted to the session zone.  The
    result is cut to whole seconds, the precision of the rendered form.
    """
    if isinstance(c, str):
        return F.expr(ts_parse_sql(_name(c)))
    s = blank_to_null(c)
    # Each strict format is tried only on text of its exact shape: a cheap
    # regex test picks the one candidate, so the formatter never has to
    # fail (a failed parse costs an exception per row).
    out = None
    for fmt in TS_FORMATS + _COLON_OFFSET_FORMATS:
        if fmt == _WEEKDAY_FORMAT:
            # The weekday letter pattern raises even inside try_to_timestamp:
            # drop the weekday and parse the rest.
            rest = F.regexp_replace(s, r"^[A-Z][a-z]{2} ", "")
            cond, val = s.rlike(_WEEKDAY_SHAPE), F.try_to_timestamp(rest, F.lit("MMM dd HH:mm:ss yyyy"))
        else:
            cond, val = s.rlike(_SHAPES[fmt]), F.try_to_timestamp(s, F.lit(fmt))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    out = out.otherwise(s.try_cast("timestamp"))  # lenient ISO-8601 fallback
    return F.date_trunc("second", out)


def ts_render(ts) -> Column:
    """Timestamp -> 'MM/dd/yyyy HH:mm:ss' text."""
    return F.date_format(_col(ts), TS_OUTPUT_FORMAT)


def ts_normalize(c) -> Column:
    """Export text -> normalised 'MM/dd/yyyy HH:mm:ss' text (NULL if unparseable)."""
    return ts_render(ts_parse(c))


def date_render(d) -> Column:
    return F.date_format(_col(d), DATE_OUTPUT_FORMAT)


def date_normalize(c) -> Column:
    """Export text -> 'MM/dd/yyyy' text."""
    return date_render(ts_parse(c))


#: years that a test of texts names, at most
MAX_YEARS = 30


def may_be_of_days(text, start: dt.date, end: dt.date) -> Column:
    """True of every text that :func:`ts_parse` reads as a time of these days, and of some others.

    A text names its year, unless it is a time alone, which is of the current
    day.  One with an offset may name the day before or after, whose year can
    be another.
    """
    if end.year - start.year >= MAX_YEARS:
        return F.lit(True)
    years = [f"{y:04d}" for y in range(start.year, end.year + 1)]
    one = dt.timedelta(days=1)
    edges = [d for d in ([start - one] if start > dt.date.min else []) + ([end + one] if end < dt.date.max else [])
             if not start.year <= d.year <= end.year]
    days = [rf"{d.year:04d}-0?{d.month}-0?{d.day}(?!\d)" for d in edges]
    return _col(text).rlike("|".join([*years, *days, r"^[^0-9]*\d{1,2}:"]))


def date_only(ts) -> Column:
    return F.to_date(_col(ts))


def duration_minutes_sql(a: str, b: str) -> str:
    secs = f"(unix_timestamp({ts_parse_sql(b)}) - unix_timestamp({ts_parse_sql(a)}))"
    return f"CAST({secs} / 60 AS BIGINT)"  # truncates toward zero


def duration_minutes(start, end) -> Column:
    """Whole minutes between two export timestamps, truncated toward zero."""
    if isinstance(start, str) and isinstance(end, str):
        return F.expr(duration_minutes_sql(_name(start), _name(end)))
    secs = F.unix_timestamp(ts_parse(end)) - F.unix_timestamp(ts_parse(start))
    return (secs / 60).cast("bigint")  # truncates toward zero


def ts_is_valid_format(c) -> Column:
    """True when text is exactly 'MM/dd/yyyy HH:mm:ss' and a real instant."""
    c = _col(c)
    return F.coalesce(
        c.rlike(r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$")
        & F.try_to_timestamp(c, F.lit(TS_OUTPUT_FORMAT)).isNotNull(),
        F.lit(False))


def ts_add_minutes(ts, minutes) -> Column:
    return _col(ts) + F.make_interval(mins=_col(minutes).cast("int"))


def ts_now() -> Column:
    return F.date_trunc("second", F.current_timestamp())
