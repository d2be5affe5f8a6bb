"""The flagship query: "my step records between two dates, newest first".

Activity-app step rows (derived from lineitem) are normalised into health
records, mapped to the parent + fitness tables, filtered by date and listed
newest first with their step metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaldf.operators import query as QY
from vitaldf.operators.records import build_records
from vitaldf.plans import testdata as TD
from vitaldf.plans.registry import prepare
from vitaldf.sources import gyroscope

START, END = "1995-01-01", "1996-12-31"


def flagship(spark: SparkSession, sf_dir: str, start: str = START, end: str = END,
             limit: int = 100) -> DataFrame:
    prepare(spark, sf_dir)
    records = build_records(gyroscope.normalize(TD.raw_steps(spark)))
    # parent and fitness columns are projections of the same records: one
    # scan, the predicates applied before the top-N (TakeOrderedAndProject)
    listed = QY.query_records(records, start, end, source="gyroscope", data_type="fitness",
                              limit=limit)
    return listed.select(
        F.date_format("timestamp", "MM/dd/yyyy HH:mm:ss").alias("timestamp"),
        "source", "data_type", "sub_type",
        F.col("metrics")["steps"]["value"].alias("steps"),
        F.coalesce(F.col("metrics")["steps"]["unit"], F.lit("steps")).alias("steps_unit"),
        F.col("metrics")["steps"]["confidence"].alias("steps_confidence"))
