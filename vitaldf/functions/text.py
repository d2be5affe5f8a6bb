"""Text, header and attribute helpers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitaldf.functions.timestamps import blank_to_null

_ATTR = r'([\w:.-]+)\s*=\s*"([^"]*)"'


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def name_slug(c) -> Column:
    """lower-case, every character outside [a-z0-9] -> '_'."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]", "_")


def slug(name: str) -> str:
    """Plan-time twin of :func:`name_slug` for header names."""
    return re.sub("[^a-z0-9]", "_", name.lower())


def col_or_null(columns: Iterable[str], name: str | None) -> Column:
    """A header column if it exists, else a typed NULL (header-level choice)."""
    if name is not None and name in set(columns):
        return F.col(f"`{name}`")
    return F.lit(None).cast("string")


def first_present_column(columns: Sequence[str], names: Sequence[str]) -> str | None:
    """First candidate that *exists* in the header, even if its values are blank."""
    present = set(columns)
    return next((n for n in names if n in present), None)


def first_matching_column(columns: Sequence[str], needles: Sequence[str],
                          lower: bool = True) -> str | None:
    """First header whose (lower-cased) name contains one of the needles."""
    for c in columns:
        hay = c.lower() if lower else c
        if any(n in hay for n in needles):
            return c
    return None


def coalesce_nonblank(*cols: Column) -> Column:
    """First non-blank *value* among candidates."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def xml_unescape(c) -> Column:
    c = _col(c)
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'")]:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def xml_attributes(c) -> Column:
    """`name="value"` pairs of one element line -> map<string,string>."""
    c = _col(c)
    keys = F.regexp_extract_all(c, F.lit(_ATTR), 1)
    vals = F.transform(F.regexp_extract_all(c, F.lit(_ATTR), 2), xml_unescape)
    # Attribute names are unique in a well-formed element; one that repeats a
    # name is malformed and yields NULL (the reader turns it into a reject).
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, vals))


def json_raw(cols: Sequence[str]) -> Column:
    """The original row as JSON text (fields the row's file lacks are left out)."""
    if not cols:
        return F.lit("{}")
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]))
