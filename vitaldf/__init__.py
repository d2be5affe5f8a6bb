"""vitaldf — Spark-native normalisation and analytics for personal health exports.

Raw app exports (CSV, JSON documents, XML dumps) are read as DataFrames,
normalised into one health-record schema, split into relational tables,
kept current by idempotent upserts and queried with built-in DataFrame
operators.  Every step is a DataFrame → DataFrame transformation.
"""

from vitaldf.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
