"""Record sets are plans: nothing is stored, and what a query does not read is not computed."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from vitaldf.operators import records
from vitaldf.operators import tables as TB
from vitaldf.operators.store import sink_json_by_type
from vitaldf.plans import registry as R
from vitaldf.sources import gyroscope

STEPS = [("gyroscope-a-steps-export.csv", "2020-01-01", str(i % 7), "manual") for i in range(200)]


def steps(spark):
    return spark.createDataFrame(STEPS, "origin string, date string, steps string, service string")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_copies_are_not_numbered_for_a_count(spark):
    r = records.build_records(gyroscope.normalize(steps(spark)))
    counted = r.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    assert "Window" not in optimized(counted) and optimized(counted).count("Aggregate") == 1
    assert [tuple(x) for x in counted.collect()] == [("gyroscope", 200)]
    assert r.select("id").distinct().count() == 200


def test_both_ways_give_the_same_numbers(spark):
    def rows(df):
        return sorted(tuple(x) for x in df.select("origin", "date", "steps", "service", "occurrence").collect())
    assert rows(records.with_occurrence(steps(spark))) == rows(records.numbered_in_place(steps(spark)))


def test_all_records_are_not_stored(spark):
    R.prepare(spark, "/root/testdata/sf0.001")
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(base))
    assert R.fin(spark).groupBy("source").count().count() == 7
    assert not {f for f in set(os.listdir(base)) - before if f.startswith("records-")}


def test_a_source_leaves_the_other_layouts_unread(spark):
    R.prepare(spark, "/root/testdata/sf0.001")
    gyro = optimized(R.recs(spark).filter(F.col("source") == "gyroscope").groupBy("sub_type").count())
    assert "gyroscope" in gyro and "sleep_tracker" not in gyro and "coach_me" not in gyro


def test_a_filter_on_maps_reads_them_finished(spark):
    r = records.build_records(gyroscope.normalize(steps(spark)))
    assert TB.map_symptoms(r).count() == 0 and TB.map_medications(r).count() == 0


def test_json_is_compressed_and_whole(spark, tmpdir_path):
    r = records.build_records(gyroscope.normalize(steps(spark)))
    sink_json_by_type(r, f"{tmpdir_path}/json")
    names = [f for _, _, fs in os.walk(f"{tmpdir_path}/json") for f in fs if f.startswith("part-")]
    assert names and all(f.endswith(".json.gz") for f in names)
    assert spark.read.json(f"{tmpdir_path}/json").select("id").distinct().count() == 200
