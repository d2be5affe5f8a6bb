"""Adapters: raw, text-typed export rows derived from the driver's tables.

The driver's tables hold no health exports, so each adapter derives the
rows an app would have written (text columns named like the export's
header, plus ``origin`` = the file the row came from).  Flat adapters are
written once as SQL rendered for two dialects — Spark SQL for the jobs and
DuckDB for the independent oracle — so both engines start from the same
text.  Everything scales with the input tables; nothing is sampled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaldf.functions import barrier

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]
SMALL_TABLES = {"region", "nation"}

_PATTERNS = {
    "ymd": ("yyyy-MM-dd", "%Y-%m-%d"),
    "ymd_hms": ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    "ymd-hms": ("yyyy-MM-dd-HH:mm:ss", "%Y-%m-%d-%H:%M:%S"),
    "mdy_hms": ("MM/dd/yyyy HH:mm:ss", "%m/%d/%Y %H:%M:%S"),
    "mdy": ("MM/dd/yyyy", "%m/%d/%Y"),
    "ymd_hm": ("yyyy-MM-dd HH:mm", "%Y-%m-%d %H:%M"),
}


class Dialect:
    def __init__(self, name: str):
        assert name in ("spark", "duckdb")
        self.name = name

    def s(self, x: str) -> str:
        return f"CAST({x} AS {'STRING' if self.name == 'spark' else 'VARCHAR'})"

    def i(self, x: str) -> str:
        """floor(x) as a 64-bit integer (both engines agree on floor)."""
        return f"CAST(FLOOR({x}) AS BIGINT)"

    def fmt(self, x: str, pattern: str) -> str:
        sp, dk = _PATTERNS[pattern]
        return f"date_format({x}, '{sp}')" if self.name == "spark" else f"strftime({x}, '{dk}')"

    def add_s(self, x: str, secs: str) -> str:
        if self.name == "spark":
            return f"timestampadd(SECOND, {secs}, {x})"
        return f"({x} + to_seconds(CAST({secs} AS BIGINT)))"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.name == "spark" else f"({a} // {b})"


# ---------------------------------------------------------------- sleep ----

def _sleep_base(d: Dialect) -> str:
    start = d.add_s("o_orderdate", "(o_orderkey * 7919) % 86400")
    return f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
           {start} AS start_ts,
           3600 + (o_orderkey * 104729) % 36000 AS dur_s
    FROM orders"""


def _ts_text(d: Dialect, ts: str, key: str) -> str:
    """Timestamp text in one of five export formats chosen by key % 5."""
    local = d.add_s(ts, "-28800")
    return f"""CASE {key} % 5
        WHEN 0 THEN {d.fmt(ts, 'ymd_hms')}
        WHEN 1 THEN {d.fmt(ts, 'ymd-hms')}
        WHEN 2 THEN {d.fmt(ts, 'mdy_hms')}
        WHEN 3 THEN {d.fmt(local, 'ymd_hms')} || ' -0800'
        ELSE {d.fmt(ts, 'ymd_hms')} || '.' || lpad({d.s(f'{key} % 1000')}, 3, '0') END"""


def sleep_quality_sql(d: Dialect) -> str:
    end = d.add_s("start_ts", "dur_s")
    mins = d.idiv("dur_s", "60")
    return f"""
    SELECT 'sleepdata.csv' AS origin,
           {d.fmt('start_ts', 'ymd_hms')} AS "Start",
           {d.fmt(end, 'ymd_hms')} AS "End",
           {d.s('40 + o_custkey % 60')} || '%' AS "Sleep quality",
           {d.s(d.idiv(mins, '60'))} || ':' || lpad({d.s(f'{mins} % 60')}, 2, '0') AS "Time in bed",
           CASE o_orderpriority WHEN '1-URGENT' THEN ':)' WHEN '2-HIGH' THEN ':|' ELSE '' END AS "Wake up",
           CASE WHEN o_orderstatus = 'F' THEN 'Stressful day' ELSE '' END AS "Sleep Notes"
    FROM ({_sleep_base(d)}) b"""


def sleep_simple_sql(d: Dialect) -> str:
    end = d.add_s("start_ts", "dur_s")
    return f"""
    SELECT 'sleep_simple.csv' AS origin,
           {_ts_text(d, 'start_ts', 'o_orderkey')} AS start_time,
           {_ts_text(d, end, 'o_orderkey')} AS end_time,
           CASE WHEN o_custkey % 2 = 0 THEN 'healthkit' ELSE '' END AS service
    FROM ({_sleep_base(d)}) b"""


def sleep_detailed_sql(d: Dialect) -> str:
    mins = d.idiv("dur_s", "60")
    return f"""
    SELECT 'sleep_detailed.csv' AS origin,
           {d.fmt('o_orderdate', 'ymd')} AS date,
           {d.fmt('start_ts', 'ymd_hm')} AS bedtime,
           {d.s(mins)} AS sleep_duration,
           '0.' || lpad({d.s('o_custkey % 100')}, 2, '0') AS efficiency,
           {d.s(d.idiv(f'{mins} * 2', '10'))} || ' min' AS deep_sleep,
           CASE WHEN o_orderkey % 4 = 2 THEN '' ELSE {d.s(d.idiv(mins, '5'))} END AS rem,
           {d.s('o_custkey % 3')} AS awake,
           {d.s('o_orderkey % 5')} AS wake_ups
    FROM ({_sleep_base(d)}) b"""


# ---------------------------------------------------------------- steps ----

def steps_sql(d: Dialect) -> str:
    q = d.s(d.i("l_quantity * 100"))
    return f"""
    SELECT 'gyroscope-u' || {d.s('l_suppkey % 10')} || '-steps-export.csv' AS origin,
           {d.fmt('l_shipdate', 'ymd')} AS date,
           CASE WHEN l_linenumber = 3 THEN {q} || ' steps'
                WHEN l_linenumber = 6 THEN ''
                ELSE {q} END AS steps,
           CASE WHEN l_returnflag = 'R' THEN 'manual' ELSE 'healthkit' END AS service
    FROM lineitem"""


# ---------------------------------------------------------------- vitals ---

def _events(d: Dialect, kind: str, cols: str, bad_every: int = 0) -> str:
    time = d.fmt("ts", "ymd-hms")
    if bad_every:  # an impossible calendar date every n-th event -> reject
        time = f"CASE WHEN event_id % {bad_every} = 0 THEN '2024-02-31-10:00:00' ELSE {time} END"
    return f"""
    SELECT 'gyroscope-u' || {d.s('user_id % 5')} || '-{kind}-export.csv' AS origin,
           {time} AS time, {cols}
    FROM events"""


def vitals_sql(d: Dialect) -> dict[str, str]:
    v = d.s(d.i("value"))
    svc = "CASE WHEN user_id % 2 = 0 THEN 'healthkit' ELSE '' END AS service"
    return {
        "bp": _events(d, "bp", f"""
            {d.s('90 + ' + d.i('value') + ' % 60')} AS systolic,
            CASE WHEN event_id % 7 = 0 THEN '0' ELSE {d.s('60 + user_id % 30')} END AS diastolic,
            {svc}""", bad_every=97),
        "glucose": _events(d, "glucose", f"""
            CASE WHEN event_id % 11 = 0 THEN ''
                 WHEN event_id % 4 = 0 THEN {v} || ' mg/dL' ELSE {v} END AS glucose, {svc}"""),
        "hrv": _events(d, "hrv", f"{d.s(d.i('value * 10'))} AS hrv, {svc}"),
        "rhr": _events(d, "rhr", f"""
            CASE WHEN event_id % 3 = 0 THEN '' ELSE {d.s('40 + ' + d.i('value') + ' % 50')} END AS rhr,
            {d.s('50 + user_id % 40')} AS heart_rate"""),
        "mood": _events(d, "mood", f"""
            {d.s('1 + event_id % 5')} AS mood,
            CASE WHEN event_id % 2 = 0 THEN 'ok' ELSE '' END AS notes, {svc}"""),
    }


# ---------------------------------------------------------------- habits ---

HABIT_NAMES = ["Eat Fruit", "Drink more water", "Weigh In", "Morning run", "Meditate",
               " Floss ", "Go to bed early", "Read 20 pages", "Take vitamins", "Call mom",
               "Yoga stretch", "Journal"]


def habits_sql(d: Dialect) -> str:
    names = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(HABIT_NAMES))
    return f"""
    SELECT 'coach.me.export.' || {d.s('o.o_custkey % 7')} || '.csv' AS origin,
           {d.s('o.o_orderkey')} AS "Id",
           CASE o.o_orderkey % {len(HABIT_NAMES)} {names} END AS "Habit",
           CASE WHEN o.o_orderkey % 50 = 0 THEN '' ELSE {d.fmt('o.o_orderdate', 'ymd')} END AS "Date",
           c.c_mktsegment AS "Note",
           CASE WHEN o.o_orderkey % 9 = 0 THEN '' ELSE {d.s('o.o_custkey % 200')} END AS "Check In Count",
           {d.s('o.o_orderkey % 30')} AS "Days in Streak",
           CASE WHEN o.o_orderkey % 4 = 0 THEN '' ELSE {d.s('o.o_orderkey % 3')} END AS "Prop Count",
           {d.s('o.o_custkey % 4')} AS "Comment Count",
           'https://coach.me/h/' || {d.s('o.o_custkey')} AS "URL"
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


# ---------------------------------------------------------------- manual ---

def _manual(d: Dialect, file: str, cols: str) -> str:
    date = (f"'2020-' || lpad({d.s('doc.doc_id % 12 + 1')}, 2, '0') || '-' || "
            f"lpad({d.s('doc.doc_id % 28 + 1')}, 2, '0')")
    return f"""
    SELECT 'manual/' || doc.source || '/{file}' AS origin, {date} AS date, {cols}
    FROM documents doc LEFT JOIN labels lab ON doc.doc_id = lab.doc_id"""


def manual_sql(d: Dialect) -> dict[str, str]:
    sev = ("CASE WHEN lab.doc_id IS NULL THEN '' WHEN lab.toxic = 1 THEN 'H' "
           "WHEN lab.quality = 1 THEN 'L' ELSE 'M' END")
    n = "doc.n_chars"
    return {
        "migraine": _manual(d, "migraine_log.csv",
                            f"{sev} AS severity, {d.s(f'{n} % 12')} AS duration_hours"),
        "symptoms": _manual(d, "symptoms.csv", f"""
            CASE doc.lang WHEN 'en' THEN 'nausea' WHEN 'fr' THEN 'fatigue' ELSE 'dizziness' END AS symptom,
            {d.s(f'{n} % 10')} || '/10' AS intensity,
            {d.s(f'{n} % 90')} AS duration_minutes"""),
        "medication": _manual(d, "medication.csv", f"""
            doc.source AS medicine, {d.s(f'{n} % 500')} || 'mg' AS dose,
            {d.s(f'1 + {n} % 3')} AS times_per_day"""),
        "mood": _manual(d, "mood.csv", f"""
            CASE WHEN lab.quality = 1 THEN 'good' ELSE 'flat' END AS feeling,
            {d.s(f'{n} % 10')} AS rating"""),
        "pain": _manual(d, "pain_diary.csv", f"""
            CASE doc.lang WHEN 'en' THEN 'back' ELSE 'knee' END AS body_part,
            {d.s(f'1 + {n} % 10')} AS pain_scale"""),
        "weight": _manual(d, "weight.csv", f"""
            {d.s(f'20 + {n} % 150')} AS body_weight,
            CASE WHEN {n} % 4 = 0 THEN '' ELSE {d.s(f'18 + {n} % 15')} END AS bmi"""),
        "blood_pressure": _manual(d, "blood_pressure.csv", f"""
            {d.s(f'100 + {n} % 50')} AS sys,
            CASE WHEN {n} % 5 = 0 THEN '' ELSE {d.s(f'60 + {n} % 30')} END AS dia"""),
        "glucose": _manual(d, "glucose.csv", f"{d.s(f'70 + {n} % 90')} || ' mg/dL' AS blood_sugar"),
        "general": _manual(d, "health_diary.csv", f"""
            {d.s(f'{n} % 10')} AS energy,
            doc.lang AS "Note Text",
            {d.s(f'{n} % 1000')} AS "Steps Walked" """),
    }


# ---------------------------------------------------------------- visits ---

def visits_sql(d: Dialect) -> str:
    start = d.add_s("o.o_orderdate", "(o.o_orderkey * 37) % 86400")
    end = d.add_s(start, "600 + o.o_orderkey % 5400")
    return f"""
    SELECT 'gyroscope-u' || {d.s('o.o_custkey % 5')} || '-gvisits-export.csv' AS origin,
           c.c_name AS "Name",
           {d.fmt(start, 'ymd_hms')} AS "Start Time",
           CASE WHEN o.o_orderkey % 10 = 0 THEN '' ELSE {d.fmt(end, 'ymd_hms')} END AS "End Time",
           {d.s('c.c_custkey % 180 - 90')} || '.5' AS "Latitude",
           {d.s('c.c_nationkey * 7 - 90')} || '.25' AS "Longitude"
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


def moves_activities_sql(d: Dialect) -> str:
    start = d.add_s("o_orderdate", "(o_orderkey * 53) % 86400")
    dur = "(60 + o_orderkey % 7200)"
    return f"""
    SELECT 'moves_export/csv/full/activities.csv' AS origin,
           {d.fmt('o_orderdate', 'ymd')} AS "Date",
           CASE o_orderkey % 4 WHEN 0 THEN 'walking' WHEN 1 THEN 'running'
                WHEN 2 THEN 'cycling' ELSE 'transport' END AS "Activity",
           CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE 'fitness' END AS "Group",
           {d.fmt(start, 'ymd_hms')} AS "Start",
           {d.fmt(d.add_s(start, dur), 'ymd_hms')} AS "End",
           {d.s(dur)} AS "Duration (s)",
           {d.s(d.idiv(f'{dur} * 3', '600'))} || '.25' AS "Distance (mi)",
           CASE WHEN o_orderkey % 4 = 2 THEN '' ELSE {d.s(f'{dur} * 2')} END AS "Steps",
           {d.s(d.idiv(dur, '10'))} AS "Calories"
    FROM orders"""


def moves_places_sql(d: Dialect) -> str:
    start = d.add_s("timestamp '2015-03-01 00:00:00'", "s_suppkey * 3600")
    return f"""
    SELECT 'moves_export/csv/full/places.csv' AS origin,
           {d.fmt(start, 'ymd')} AS "Date",
           s_name AS "Name",
           {d.fmt(start, 'ymd_hms')} AS "Start",
           {d.fmt(d.add_s(start, 's_suppkey % 3600 + 60'), 'ymd_hms')} AS "End",
           {d.s('s_suppkey % 3600 + 60')} AS "Duration",
           CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE {d.s('s_nationkey - 12')} || '.125' END AS "Latitude",
           {d.s('s_suppkey % 170')} || '.5' AS "Longitude",
           CASE s_nationkey % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'work' ELSE '' END AS "Category",
           CASE WHEN s_suppkey % 2 = 0 THEN 'https://example.org/p/' || {d.s('s_suppkey')} ELSE ' ' END AS "Link"
    FROM supplier"""


# ---------------------------------------------------------------- xml ------

APPLE_SAMPLE_TYPES = [
    ("error", "HKQuantityTypeIdentifierHeartRate", "count/min"),
    ("click", "HKQuantityTypeIdentifierStepCount", "count"),
    ("signup", "HKQuantityTypeIdentifierBodyMass", "lb"),
    ("view", "HKQuantityTypeIdentifierBloodPressureSystolic", "mmHg"),
    ("purchase", "HKQuantityTypeIdentifierDietaryWater", "mL"),
]


def xml_lines_sql(d: Dialect) -> str:
    """One `<Record .../>` line per event; every 7th event has an unmapped type,
    every 13th is a `<Workout .../>`."""
    types = " ".join(f"WHEN '{e}' THEN '{t}'" for e, t, _ in APPLE_SAMPLE_TYPES)
    units = " ".join(f"WHEN '{e}' THEN '{u}'" for e, _, u in APPLE_SAMPLE_TYPES)
    local = d.add_s("ts", "-28800")
    end = d.add_s(local, "event_id % 600")
    src = ("CASE user_id % 3 WHEN 0 THEN 'Apple Watch' WHEN 1 THEN 'Health' "
           "ELSE 'Scale &amp; Co' END")
    val = f"{d.s(d.i('value'))} || '.' || {d.s('event_id % 10')}"
    rec = f"""'  <Record type="' ||
           CASE WHEN event_id % 7 = 0 THEN 'HKQuantityTypeIdentifierUnmapped'
                ELSE CASE event_type {types} END END ||
           '" sourceName="' || {src} || '" sourceVersion="' || {d.s('user_id % 4')} ||
           '" unit="' || CASE event_type {units} END ||
           '" creationDate="' || {d.fmt(local, 'ymd_hms')} || ' -0800' ||
           '" startDate="' || {d.fmt(local, 'ymd_hms')} || ' -0800' ||
           '" endDate="' || {d.fmt(end, 'ymd_hms')} || ' -0800' ||
           '" value="' || {val} || '"/>'"""
    wk = f"""'  <Workout workoutActivityType="HKWorkoutActivityTypeRunning" duration="' ||
           {d.s('event_id % 90')} || '" durationUnit="min" totalDistance="' || {val} ||
           '" totalDistanceUnit="km" totalEnergyBurned="' || {d.s('event_id % 700')} ||
           '" totalEnergyBurnedUnit="kcal" sourceName="' || {src} ||
           '" startDate="' || {d.fmt(local, 'ymd_hms')} || ' -0800' ||
           '" endDate="' || {d.fmt(end, 'ymd_hms')} || ' -0800' || '">'"""
    return f"""
    SELECT 'apple_health_export_' || {d.s('user_id % 3')} || '/export.xml' AS origin,
           CASE WHEN event_id % 13 = 0 THEN 'Workout' ELSE 'Record' END AS tag,
           CASE WHEN event_id % 13 = 0 THEN {wk} ELSE {rec} END AS line
    FROM events"""


# ---------------------------------------------------------------- json -----

def moves_json_activities_sql(d: Dialect) -> str:
    local = d.add_s("ts", "0")
    return f"""
    SELECT 'moves_export/json/full/activities.json' AS origin,
           {d.fmt(local, 'ymd_hms')} AS "startTime",
           {d.fmt(d.add_s(local, 'event_id % 3600'), 'ymd_hms')} AS "endTime",
           CASE event_type WHEN 'click' THEN 'walking' WHEN 'view' THEN 'running'
                WHEN 'error' THEN '' ELSE 'cycling' END AS activity,
           CAST(event_id % 3600 AS DOUBLE) AS duration,
           CAST({d.i('value')} AS DOUBLE) AS distance
    FROM events"""


# ---------------------------------------------------------------- inventory

def inventory_sql(d: Dialect) -> str:
    pid = d.s("page_id")
    return f"""
    SELECT '/exports/' || CASE page_id % 10
             WHEN 0 THEN 'gyroscope/gyroscope-u' || {pid} || '-steps-export.csv'
             WHEN 1 THEN 'Run Data/NikePlus Run Data/NikePlus-2013-11-23-p' || {pid} || '.json'
             WHEN 2 THEN 'apple_health_export_' || {pid} || '/export.xml'
             WHEN 3 THEN 'coach.me.export.' || {pid} || '.csv'
             WHEN 4 THEN 'sleep_' || {pid} || '.csv'
             WHEN 5 THEN 'migraine_log_' || {pid} || '.csv'
             WHEN 6 THEN 'moves_export/csv/full/places_' || {pid} || '.csv'
             WHEN 7 THEN 'archive/backup_' || {pid} || '.zip'
             WHEN 8 THEN 'pages/page_' || {pid} || '.html'
             ELSE 'notes/readme_' || {pid} || '.txt' END AS path,
           CAST(length(html) AS BIGINT) AS length,
           {d.add_s("timestamp '2024-01-01 00:00:00'", 'page_id * 60')} AS "modificationTime"
    FROM pages"""


# ------------------------------------------------------------ Spark side ---

SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Expose the driver's parquet tables as views (scans stay lazy).

    A table that Spark reads in fewer splits than there are task slots is
    small (a split holds 4 MB at least) and often one row group, read by one
    task: its rows (of the columns that a query uses) are dealt out.  A larger
    one is read as it is split, without a shuffle, in however few files it is.
    """
    slots = spark.sparkContext.defaultParallelism
    for t in TABLES:
        table = spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
        if t not in SMALL_TABLES and len(table.inputFiles()) < slots and table.rdd.getNumPartitions() < slots:
            table = table.repartition(slots, *table.columns[:1])
        table.createOrReplaceTempView(t)


def spark_sql_text(sql: str) -> str:
    """Shared SQL quotes output names as ``AS "name"``; Spark wants backticks."""
    return re.sub(r'AS "([^"]+)"', r"AS `\1`", sql)


def raw(spark: SparkSession, sql: str) -> DataFrame:
    """Export rows, as if read from files: later expressions don't take in those that made a column."""
    rows = spark.sql(spark_sql_text(sql))
    return rows.select(*[barrier(F.col(f"`{c}`")).alias(c) for c in rows.columns])


def raw_steps(spark):
    return raw(spark, steps_sql(SPARK))


def raw_sleep(spark) -> dict[str, DataFrame]:
    return {"quality": raw(spark, sleep_quality_sql(SPARK)),
            "simple": raw(spark, sleep_simple_sql(SPARK)),
            "detailed": raw(spark, sleep_detailed_sql(SPARK))}


def raw_vitals(spark) -> dict[str, DataFrame]:
    return {k: raw(spark, q) for k, q in vitals_sql(SPARK).items()}


def raw_habits(spark):
    return raw(spark, habits_sql(SPARK))


def raw_manual(spark) -> dict[str, DataFrame]:
    return {k: raw(spark, q) for k, q in manual_sql(SPARK).items()}


def raw_visits(spark):
    return raw(spark, visits_sql(SPARK))


def raw_moves_activities(spark):
    return raw(spark, moves_activities_sql(SPARK))


def raw_moves_places(spark):
    return raw(spark, moves_places_sql(SPARK))


def raw_xml(spark):
    return raw(spark, xml_lines_sql(SPARK))


def raw_moves_json_activities(spark):
    return raw(spark, moves_json_activities_sql(SPARK))


def raw_inventory(spark):
    return raw(spark, inventory_sql(SPARK))


NIKE_TYPES = ["FUEL", "STEPS", "CALORIES", "DISTANCE"]


def raw_minutes(spark: SparkSession) -> DataFrame:
    """One wristband JSON document per order: a summary and one minute series.

    Series values are the order's quantities ordered by (line number,
    quantity) — line numbers repeat within an order, so the quantity breaks
    ties — with every third line reported as "0".  Lines go to their order's
    task as the few numbers read of them; lists and texts are made there.
    """
    li = spark.table("lineitem").select("l_orderkey", "l_shipdate", "l_quantity", "l_extendedprice",
                                        "l_linenumber").repartition("l_orderkey")

    def val(line):
        return F.when(line["ln"] % 3 == 0, F.lit("0")).otherwise(F.floor(line["q"]).cast("string"))

    g = li.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"),
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("qty"),
        F.sum(F.floor("l_extendedprice")).alias("price"),
        F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("ln"),
                                             F.col("l_quantity").alias("q")))).alias("series"))
    key = F.col("l_orderkey")
    mtype = F.element_at(F.array(*[F.lit(t) for t in NIKE_TYPES]), (key % 4 + 1).cast("int"))
    return g.select(
        F.concat(F.lit("NikePlus-"), F.date_format("first_ship", "yyyy-MM-dd"), F.lit("-act"),
                 key.cast("string"), F.lit("-NoGPS.json")).alias("origin"),
        F.when(key % 6 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("act"), key.cast("string"))).alias("activityId"),
        F.lit("America/Los_Angeles").alias("activityTimeZone"),
        F.when(key % 2 == 0, F.lit("ALL_DAY")).alias("activityType"),
        F.lit("FUELBAND2").alias("deviceType"),
        F.struct(
            (F.col("price") % 5000).cast("double").alias("calories"),
            (F.col("qty") / 8).alias("distance"),
            F.concat(F.col("n").cast("string"), F.lit(":"),
                     F.lpad((F.col("qty").cast("bigint") % 60).cast("string"), 2, "0"),
                     F.lit(":30.000")).alias("duration"),
            F.when(key % 5 == 0, F.lit(0.0)).otherwise(F.col("n") * 100.0).alias("fuel"),
            (F.col("qty") * 10).alias("steps"),
        ).alias("metricSummary"),
        F.array(F.struct(mtype.alias("metricType"),
                         (key % 2 + 1).cast("bigint").alias("intervalMetric"),
                         F.transform("series", val).alias("values"))).alias("metrics"),
    )


def raw_storyline(spark: SparkSession) -> DataFrame:
    """Storyline JSON items: one per conversation, one segment per turn
    (user turns are place visits, assistant turns are moves)."""
    cv = spark.table("conversations")
    start = F.timestamp_seconds(F.lit(1420070400) + F.col("conv_id") * 86400 + F.col("turn") * 600)
    start_s = F.date_format(start, "yyyy-MM-dd HH:mm:ss")
    end_s = F.date_format(start + F.expr("INTERVAL 5 MINUTES"), "yyyy-MM-dd HH:mm:ss")
    is_user = F.col("role") == "user"
    seg = F.struct(
        F.col("turn").alias("turn"),
        F.when(is_user, "place").otherwise("move").alias("type"),
        start_s.alias("startTime"), end_s.alias("endTime"),
        F.when(is_user, F.struct(
            F.concat(F.lit("place-"), (F.col("conv_id") % 17).cast("string")).alias("name"),
            F.when(F.col("turn") % 3 == 0, "home").alias("type"),
            F.when(F.col("turn") % 4 != 1, F.struct(
                (F.col("conv_id") % 90 + 0.5).alias("lat"),
                (F.col("turn") % 180 + 0.25).alias("lon"))).alias("location"))).alias("place"),
        F.when(~is_user, F.array(F.struct(
            start_s.alias("startTime"), end_s.alias("endTime"),
            F.when(F.length("text") % 2 == 0, "walking").otherwise("running").alias("activity"),
            (F.length("text") % 1800).cast("double").alias("duration"),
            (F.length("text") * 1.0).alias("distance")))).alias("activities"))
    g = cv.groupBy("conv_id").agg(F.array_sort(F.collect_list(seg)).alias("segs"))
    return g.select(
        F.lit("moves_export/json/full/storyline.json").alias("origin"),
        F.transform("segs", lambda s: s.dropFields("turn")).alias("segments"))


# ------------------------------------------------------- more layouts -------

def workouts_sql(d: Dialect) -> str:
    """Activity-app workout files (workouts / running / cycling); every 40th
    row has no start time and must be rejected."""
    start = d.add_s("o_orderdate", "(o_orderkey * 11) % 86400")
    end = d.add_s(start, "300 + o_orderkey % 5000")
    return f"""
    SELECT 'gyroscope-u' || {d.s('o_custkey % 3')} || '-' ||
             CASE o_orderkey % 3 WHEN 0 THEN 'workouts' WHEN 1 THEN 'running' ELSE 'cycling' END ||
             '-export.csv' AS origin,
           {d.s('o_orderkey')} AS id,
           CASE WHEN o_orderkey % 40 = 3 THEN '' ELSE {d.fmt(start, 'ymd-hms')} END AS start_time,
           {d.fmt(end, 'ymd-hms')} AS end_time,
           CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS type,
           CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'session ' || {d.s('o_orderkey % 97')} END AS name,
           'gyroscope' AS service,
           CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE {d.s(d.i('o_totalprice / 100'))} END AS calories
    FROM orders"""


def gyro_sleep_sql(d: Dialect) -> str:
    start = d.add_s("o_orderdate", "(o_orderkey * 7919) % 86400")
    end = d.add_s(start, "3600 + (o_orderkey * 104729) % 36000")
    return f"""
    SELECT 'gyroscope-u' || {d.s('o_custkey % 3')} || '-sleep-export.csv' AS origin,
           {d.fmt(start, 'ymd-hms')} AS start_time,
           {d.fmt(end, 'ymd-hms')} AS end_time,
           CASE WHEN o_orderkey % 2 = 0 THEN 'healthkit' ELSE 'manual' END AS service
    FROM orders"""


def sleep_generic_sql(d: Dialect) -> str:
    """A layout the sleep reader does not know: any date column + numbers."""
    return f"""
    SELECT 'sleep_log.csv' AS origin,
           CASE WHEN c_custkey % 25 = 0 THEN '' ELSE
             '2021-' || lpad({d.s('c_custkey % 12 + 1')}, 2, '0') || '-' ||
             lpad({d.s('c_nationkey + 1')}, 2, '0') END AS "Night Date",
           {d.s('4 + c_custkey % 6')} || 'h' AS "Hours Slept",
           '0.' || {d.s('c_custkey % 10')} AS "Score %",
           c_mktsegment AS "Mood"
    FROM customer"""


def moves_storyline_csv_sql(d: Dialect) -> str:
    start = d.add_s("o_orderdate", "(o_orderkey * 29) % 86400")
    kind = "o_orderkey % 3"
    return f"""
    SELECT 'moves_export/csv/full/storyline.csv' AS origin,
           {d.fmt('o_orderdate', 'ymd')} AS "Date",
           CASE WHEN {kind} = 0 THEN 'walking' ELSE '' END AS "Activity",
           CASE WHEN {kind} = 0 THEN 'walking' ELSE '' END AS "Group",
           CASE WHEN {kind} = 1 THEN 'Stop ' || {d.s('o_custkey % 50')} ELSE '' END AS "Name",
           CASE WHEN {kind} = 1 THEN {d.s('o_custkey % 80')} || '.5' ELSE '' END AS "Latitude",
           CASE WHEN {kind} = 1 THEN {d.s('o_custkey % 100')} || '.5' ELSE '' END AS "Longitude",
           CASE WHEN o_orderkey % 25 = 0 THEN '' ELSE {d.fmt(start, 'ymd_hms')} END AS "Start",
           {d.fmt(d.add_s(start, '900'), 'ymd_hms')} AS "End",
           '900' AS "Duration"
    FROM orders"""


def moves_summary_sql(d: Dialect) -> str:
    return f"""
    SELECT 'moves_export/csv/full/summary.csv' AS origin,
           {d.fmt('l_shipdate', 'ymd')} AS "Date",
           {d.s(d.i('l_quantity * 100'))} AS "Steps",
           {d.s(d.i('l_quantity'))} || '.5' AS "Distance",
           CASE WHEN l_linenumber = 2 THEN '' ELSE {d.s(d.i('l_extendedprice / 100'))} END AS "Calories",
           {d.s('l_linenumber * 600')} AS "Duration"
    FROM lineitem"""


def moves_places_json_sql(d: Dialect) -> str:
    start = d.add_s("timestamp '2016-06-01 00:00:00'", "c_custkey * 1800")
    return f"""
    SELECT 'moves_export/json/full/places.json' AS origin,
           {d.fmt(start, 'ymd_hms')} AS "startTime",
           CASE WHEN c_custkey % 3 = 0 THEN '' ELSE {d.fmt(d.add_s(start, '1200'), 'ymd_hms')} END AS "endTime",
           c_name AS place_name, c_mktsegment AS place_type,
           CAST(c_nationkey AS DOUBLE) + 0.5 AS lat,
           CAST(c_custkey % 180 AS DOUBLE) - 0.5 AS lon
    FROM customer"""


def raw_workouts(spark):
    return raw(spark, workouts_sql(SPARK))


def raw_gyro_sleep(spark):
    return raw(spark, gyro_sleep_sql(SPARK))


def raw_sleep_generic(spark):
    return raw(spark, sleep_generic_sql(SPARK))


def raw_moves_storyline_csv(spark):
    return raw(spark, moves_storyline_csv_sql(SPARK))


def raw_moves_summary(spark):
    return raw(spark, moves_summary_sql(SPARK))


def raw_moves_places_json(spark):
    """places.json items: {startTime, endTime, place{name, type, location{lat, lon}}}."""
    flat = raw(spark, moves_places_json_sql(SPARK))
    return flat.select(
        "origin", "startTime", F.when(F.col("endTime") != "", F.col("endTime")).alias("endTime"),
        F.struct(F.col("place_name").alias("name"), F.col("place_type").alias("type"),
                 F.struct(F.col("lat").alias("lat"), F.col("lon").alias("lon")).alias("location")
                 ).alias("place"))


def raw_moves_json_activity_items(spark):
    df = raw_moves_json_activities(spark)
    return df.select("origin", "startTime", "endTime",
                     F.when(F.col("activity") != "", F.col("activity")).alias("activity"),
                     "duration", "distance")


def moves_generic_sql(d: Dialect) -> str:
    """A movement-app CSV whose name maps to no known kind."""
    return f"""
    SELECT 'moves_export/csv/full/daily.csv' AS origin,
           CASE WHEN n_nationkey % 6 = 0 THEN '' ELSE
             '2015-01-' || lpad({d.s('n_nationkey + 1')}, 2, '0') END AS "Day Start",
           n_name AS "Label"
    FROM nation"""


def raw_moves_generic(spark):
    return raw(spark, moves_generic_sql(SPARK))
