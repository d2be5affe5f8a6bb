"""Column functions against the fixture values (timestamps, numbers, lookups)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitaldf import functions as V


def one(spark, col, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("r")).first()["r"]


def test_timestamp_formats(spark):
    cases = {
        "2018-08-02": "08/02/2018 00:00:00",
        "2013-05-20-08:43:00": "05/20/2013 08:43:00",
        "2013-09-30 01:11:48": "09/30/2013 01:11:48",
        "2015-03-12 18:11 +0000": "03/12/2015 18:11:00",
        "2020-02-07": "02/07/2020 00:00:00",
        "2023-01-01 08:00:00 -0800": "01/01/2023 16:00:00",
        "01/02/2020 10:11:12": "01/02/2020 10:11:12",
        "2020-01-02 10:11:12.345": "01/02/2020 10:11:12",
        "Sat Nov 23 10:00:00 2013": "11/23/2013 10:00:00",
        "2020-01-02T10:11:12Z": "01/02/2020 10:11:12",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["n"] for r in rows.select("s", V.ts_normalize("s").alias("n")).collect()}
    assert got == cases


def test_timestamp_rejects(spark):
    for bad in ["2013-02-31", "abc", "", None]:
        assert one(spark, V.ts_normalize("s"), bad) is None


def test_column_and_name_paths_agree(spark):
    df = spark.createDataFrame([("2013-05-20-08:43:00",), ("2015-03-12 18:11 +0000",)], "s string")
    a = [r[0] for r in df.select(V.ts_parse("s")).collect()]
    b = [r[0] for r in df.select(V.ts_parse(F.col("s"))).collect()]
    assert a == b


def test_duration_truncates(spark):
    df = spark.createDataFrame([("2013-09-30 01:11:48", "2013-09-30 08:02:47"),
                                ("2013-05-20-08:43:00", "2013-05-20-15:15:00"),
                                ("2020-01-01 00:01:30", "2020-01-01 00:00:00")], "a string, b string")
    got = [r[0] for r in df.select(V.duration_minutes("a", "b")).collect()]
    assert got == [410, 392, -1]


def test_number_prefix(spark):
    df = spark.createDataFrame([("12.5abc",), ("abc",), ("  7",), ("",)], "s string")
    got = [(r[0], r[1]) for r in df.select(V.int_prefix("s"), V.float_prefix("s")).collect()]
    assert got == [(12.0, 12.5), (None, None), (7.0, 7.0), (None, None)]


def test_strip_and_percent(spark):
    assert one(spark, V.strip_parse("s"), "7/10") == 710.0
    assert one(spark, V.strip_parse("s"), "120 mg") == 120.0
    assert one(spark, V.strip_parse("s"), "none") is None
    assert one(spark, V.pct_parse("s"), "75%") == 75.0


def test_hm_and_hms(spark):
    assert one(spark, V.duration_hm_minutes("s"), "6:50") == 410.0
    assert one(spark, V.duration_hm_minutes("s"), "42") == 42.0
    assert one(spark, V.duration_hm_minutes("s"), "x") == 0.0
    assert one(spark, V.duration_hms_minutes("s"), "9:06:00.000") == 546.0
    assert one(spark, V.duration_hms_minutes("s"), "9:06") == 0.0


def test_lookups(spark):
    assert one(spark, V.habit_categorize("s"), "Eat Fruit") == "nutrition"
    assert one(spark, V.habit_categorize("s"), "Weigh In") == "health_monitoring"
    assert one(spark, V.habit_categorize("s"), "Call mom") == "other"
    assert one(spark, V.severity_map("s"), "H") == "high"
    assert one(spark, V.severity_map("s"), "severe") == "severe"
    assert one(spark, V.unit_map_apple("s"), "count/min") == "bpm"
    assert one(spark, V.unit_map_apple("s"), "mL") == "mL"
    assert one(spark, V.subtype_apple("s"), "HKQuantityTypeIdentifierBodyMass") == "bodymass"
    assert one(spark, V.datatype_apple("s"), "HKFoo") == "unknown"
    assert one(spark, V.confidence_source("s"), "Bob's iPhone") == 0.9
    assert one(spark, V.gyro_sub_type("s"), "x/gyroscope-Test-bp-export.csv") == "bp"
    assert one(spark, V.gyro_sub_type("s"), "gyroscope-Test-bp-empty-export.csv") == "unknown"
    assert one(spark, V.classify_file_manual("s"), "/a/my_migraines.csv") == "migraine"
    assert one(spark, V.classify_file_manual("s"), "/a/diary.csv") == "general"


def test_xml_attributes(spark):
    line = ('<Record type="HKQuantityTypeIdentifierStepCount" sourceName="Tom &amp; Co" '
            'value="5"/>')
    m = one(spark, V.xml_attributes("s"), line)
    assert m == {"type": "HKQuantityTypeIdentifierStepCount", "sourceName": "Tom & Co", "value": "5"}
    assert one(spark, V.xml_attributes("s"), '<Record a="1" a="2"/>') is None


def test_slug():
    assert V.slug("Steps Walked") == "steps_walked"
    assert V.slug("Score %") == "score__"
