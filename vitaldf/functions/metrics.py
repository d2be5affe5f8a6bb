"""Metric triples {value, unit, confidence} and the open-field maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitaldf.schema import LOCATION, METRIC


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def barrier(c: Column) -> Column:
    """``c`` unchanged, but the projection holding it is non-deterministic.

    Catalyst neither pushes filters through nor inlines such a projection,
    so an expensive column (a parse of the raw line) is computed once per
    row instead of being copied into every downstream predicate.  The guard
    is always true and cannot be folded by the optimiser.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def metric(value, unit, confidence=1.0) -> Column:
    """Build a metric struct; the value is a double (NULL = not a number)."""
    return F.struct(
        _lit(value).cast("double").alias("value"),
        _lit(unit).cast("string").alias("unit"),
        _lit(confidence).cast("double").alias("confidence"),
    )


def metric_when(cond: Column, value, unit, confidence=1.0) -> Column:
    return F.when(cond, metric(value, unit, confidence))


def null_metric() -> Column:
    return F.lit(None).cast(METRIC)


def typed_map(entries: Mapping[str, Column], value_type: str) -> Column:
    """name -> optional value; entries whose value is NULL are left out.

    Built as ``map_concat`` of single-entry maps (compiled by whole-stage
    codegen) rather than ``map_filter`` with a lambda (interpreted per row).
    """
    empty = F.create_map().cast(f"map<string,{value_type}>")
    if not entries:
        return empty
    parts = []
    for k, v in entries.items():
        v = _lit(v).cast(value_type)
        parts.append(F.when(v.isNotNull(), F.create_map(F.lit(k), v)).otherwise(empty))
    return parts[0] if len(parts) == 1 else F.map_concat(*parts)


def metric_map(entries: Mapping[str, Column]) -> Column:
    """name -> optional metric; entries that evaluate to NULL are left out."""
    return typed_map(entries, METRIC.simpleString())


def string_map(entries: Mapping[str, Column]) -> Column:
    """name -> optional text; NULL values are left out."""
    return typed_map(entries, "string")


def location(name, latitude, longitude) -> Column:
    return F.struct(
        _lit(name).cast("string").alias("name"),
        _lit(latitude).cast("double").alias("latitude"),
        _lit(longitude).cast("double").alias("longitude"),
    )


def null_location() -> Column:
    return F.lit(None).cast(LOCATION)


def metric_value(m) -> Column:
    """Value of a metric (NULL metric -> NULL)."""
    return _col(m).getField("value")


def metric_unit(m, default: str | None = None) -> Column:
    """Unit of a metric; the default when the metric or its unit is missing."""
    u = _col(m).getField("unit")
    return F.coalesce(F.when(u != "", u), F.lit(default).cast("string"))


def metric_confidence(m) -> Column:
    """Confidence of a metric: NULL metric -> NULL, missing confidence -> 1.0."""
    m = _col(m)
    return F.when(m.isNotNull(), F.coalesce(m.getField("confidence"), F.lit(1.0)))


def m(name: str) -> Column:
    """Metric `name` of a record row."""
    return F.col("metrics").getItem(name)


def attr(name: str) -> Column:
    return F.col("attrs").getItem(name)


def time_of(name: str) -> Column:
    return F.col("times").getItem(name)
