"""Queries for the scalar column functions (survey §2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitaldf import functions as V
from vitaldf.operators import tables as TB
from vitaldf.plans import oracle as O
from vitaldf.plans import testdata as TD
from vitaldf.plans.registry import at, day_out, mc, mu, mv, q, recs, ts_out

D = TD.DUCK


def ok(sql: str) -> str:
    return f"SELECT * FROM ({sql}) t WHERE ts IS NOT NULL"


# ------------------------------------------------------------- date / time --

@q("ts_normalize", lambda: f"""
    SELECT start_time AS ts_text, {O.orender(O.ots('start_time'))} AS normalized
    FROM ({TD.sleep_simple_sql(D)}) a""")
def ts_normalize(spark):
    return TD.raw_sleep(spark)["simple"].select(
        F.col("start_time").alias("ts_text"), V.ts_normalize("start_time").alias("normalized"))


@q("date_normalize", lambda: f"""
    SELECT end_time AS ts_text, {O.odate(O.ots('end_time'))} AS normalized_date
    FROM ({TD.sleep_simple_sql(D)}) a""")
def date_normalize(spark):
    return TD.raw_sleep(spark)["simple"].select(
        F.col("end_time").alias("ts_text"), V.date_normalize("end_time").alias("normalized_date"))


@q("duration_minutes", lambda: f"""
    SELECT start_time, end_time, {O.odur('start_time', 'end_time')} AS minutes
    FROM ({TD.sleep_simple_sql(D)}) a""")
def duration_minutes(spark):
    return TD.raw_sleep(spark)["simple"].select(
        "start_time", "end_time", V.duration_minutes("start_time", "end_time").alias("minutes"))


@q("ts_now", lambda: f"""
    SELECT count(*) AS records, true AS stamped FROM ({ok(O.o_gyro_steps())}) t""")
def ts_now(spark):
    r = recs(spark, "gyro_steps")
    return r.agg(F.count(F.lit(1)).alias("records"),
                 F.coalesce(F.min(F.col("processed_at")) > F.lit("2020-01-01").cast("timestamp"),
                            F.lit(True)).alias("stamped"))


def _valid_sql(t: str) -> str:
    return (f"COALESCE(regexp_full_match({t}, '\\d{{2}}/\\d{{2}}/\\d{{4}} \\d{{2}}:\\d{{2}}:\\d{{2}}') "
            f"AND try_strptime({t}, '%m/%d/%Y %H:%M:%S') IS NOT NULL, false)")


@q("ts_is_valid_format", lambda: f"""
    SELECT start_time AS ts_text, {_valid_sql('start_time')} AS text_valid,
           {_valid_sql(O.orender(O.ots('start_time')))} AS normalized_valid
    FROM ({TD.sleep_simple_sql(D)}) a""")
def ts_is_valid_format(spark):
    return TD.raw_sleep(spark)["simple"].select(
        F.col("start_time").alias("ts_text"),
        V.ts_is_valid_format("start_time").alias("text_valid"),
        V.ts_is_valid_format(V.ts_normalize("start_time")).alias("normalized_valid"))


def _tib_sql() -> str:
    part = "TRY_CAST(NULLIF(regexp_extract(split_part(\"Time in bed\", ':', {i}), '^\\s*([+-]?\\d+)', 1), '') AS BIGINT)"
    return f"({part.format(i=1)} * 60 + {part.format(i=2)})"


@q("ts_add_minutes", lambda: f"""
    SELECT "Start" AS start, "Time in bed" AS time_in_bed,
           {O.orender(f"{O.ots('\"Start\"')} + to_minutes({_tib_sql()})")} AS wake_estimate
    FROM ({TD.sleep_quality_sql(D)}) a""")
def ts_add_minutes(spark):
    r = TD.raw_sleep(spark)["quality"]
    return r.select(F.col("Start").alias("start"), F.col("Time in bed").alias("time_in_bed"),
                    V.ts_render(V.ts_add_minutes(V.ts_parse("Start"),
                                                 V.duration_hm_minutes("Time in bed")))
                    .alias("wake_estimate"))


@q("duration_hms_parse", lambda: f"""
    SELECT origin, duration AS duration_minutes FROM ({O.o_nike_summary()}) t""")
def duration_hms_parse(spark):
    return TD.raw_minutes(spark).select(
        "origin", V.duration_hms_minutes(F.col("metricSummary.duration")).alias("duration_minutes"))


@q("duration_hm_parse", lambda: f"""
    SELECT "Time in bed" AS time_in_bed, CAST({_tib_sql()} AS DOUBLE) AS minutes
    FROM ({TD.sleep_quality_sql(D)}) a""")
def duration_hm_parse(spark):
    r = TD.raw_sleep(spark)["quality"]
    return r.select(F.col("Time in bed").alias("time_in_bed"),
                    V.duration_hm_minutes("Time in bed").alias("minutes"))


@q("date_only", lambda: f"""
    SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date_only, count(*) AS records
    FROM ({ok(O.o_gyro_steps())}) t GROUP BY 1""")
def date_only(spark):
    return recs(spark, "gyro_steps").groupBy(day_out().alias("date_only")).agg(
        F.count(F.lit(1)).alias("records"))


# ------------------------------------------------------------- numbers -----

@q("num_prefix_parse", lambda: f"""
    SELECT glucose AS text, {O.ofloat('glucose')} AS float_value,
           {O.oint('glucose')} AS int_value
    FROM ({TD.vitals_sql(D)['glucose']}) a""")
def num_prefix_parse(spark):
    r = TD.raw_vitals(spark)["glucose"]
    return r.select(F.col("glucose").alias("text"), V.float_prefix("glucose").alias("float_value"),
                    V.int_prefix("glucose").alias("int_value"))


@q("num_strip_parse", lambda: f"""
    SELECT intensity AS text, {O.ostrip('intensity')} AS value
    FROM ({TD.manual_sql(D)['symptoms']}) a""")
def num_strip_parse(spark):
    r = TD.raw_manual(spark)["symptoms"]
    return r.select(F.col("intensity").alias("text"), V.strip_parse("intensity").alias("value"))


@q("pct_parse", lambda: f"""
    SELECT "Sleep quality" AS text, {O.ofloat("replace(\"Sleep quality\", '%', '')")} AS percent
    FROM ({TD.sleep_quality_sql(D)}) a""")
def pct_parse(spark):
    r = TD.raw_sleep(spark)["quality"]
    return r.select(F.col("Sleep quality").alias("text"), V.pct_parse("Sleep quality").alias("percent"))


@q("name_slug", lambda: f"""
    SELECT "Habit" AS habit, regexp_replace(lower("Habit"), '[^a-z0-9]', '_', 'g') AS slug
    FROM ({TD.habits_sql(D)}) a""")
def name_slug(spark):
    r = TD.raw_habits(spark)
    return r.select(F.col("Habit").alias("habit"), V.name_slug("Habit").alias("slug"))


@q("metric_make", lambda: f"""
    SELECT {O.orender('ts')} AS timestamp, steps AS value, 'steps' AS unit,
           steps_confidence AS confidence FROM ({ok(O.o_gyro_steps())}) t""")
def metric_make(spark):
    return recs(spark, "gyro_steps").select(ts_out().alias("timestamp"), mv("steps").alias("value"),
                                            mu("steps").alias("unit"), mc("steps").alias("confidence"))


@q("metric_value_unit_confidence", lambda: f"""
    SELECT sub_type, rhr AS resting_heart_rate, 'bpm' AS resting_hr_unit,
           CASE WHEN rhr IS NOT NULL OR sub_type = 'rhr' THEN 0.8 END::DOUBLE AS resting_hr_confidence,
           glucose, 'mg/dL' AS glucose_unit,
           CASE WHEN sub_type = 'glucose' AND glucose IS NOT NULL THEN 0.8 END::DOUBLE AS glucose_confidence
    FROM ({ok(O.o_gyro_vitals())}) t""")
def metric_value_unit_confidence(spark):
    v = TB.map_vitals(recs(spark, "gyro_vitals"), ["sub_type"])
    return v.select(
        "sub_type", "resting_heart_rate", "resting_hr_unit", "resting_hr_confidence",
        "glucose", "glucose_unit", "glucose_confidence")


# ------------------------------------------------------------- units, lookups

@q("unit_map_apple", lambda: f"""
    SELECT unit AS raw_unit, {O.apple_unit_case('unit')} AS unit
    FROM ({O.o_xml_attrs()}) x WHERE tag = 'Record'""")
def unit_map_apple(spark):
    from vitaldf.sources import apple
    e = apple.with_attributes(TD.raw_xml(spark)).filter(F.col("tag") == "Record")
    return e.select(F.col("attrs")["unit"].alias("raw_unit"),
                    V.unit_map_apple(F.col("attrs")["unit"]).alias("unit"))


_DETAILED = ["sleep_duration", "sleep_efficiency", "deep_sleep", "rem_sleep", "awake_time", "wake_ups"]


@q("unit_infer_sleep", lambda: f"""
    SELECT {O.orender('ts')} AS timestamp, {', '.join(f'{m}, {m}_unit' for m in _DETAILED)}
    FROM ({ok(O.o_sleep_detailed())}) t""")
def unit_infer_sleep(spark):
    r = recs(spark, "sleep_detailed")
    cols = []
    for m in _DETAILED:
        cols += [mv(m).alias(m), mu(m).alias(f"{m}_unit")]
    return r.select(ts_out().alias("timestamp"), *cols)


@q("unit_infer_manual", lambda: f"""
    SELECT weight, CASE WHEN weight IS NOT NULL THEN weight_unit END AS weight_unit
    FROM ({ok(O.o_manual()['weight'])}) t""")
def unit_infer_manual(spark):
    return recs(spark, "manual_weight").select(mv("weight").alias("weight"),
                                               mu("weight").alias("weight_unit"))


@q("unit_convert", lambda: f"""
    SELECT "Duration (s)" AS duration_s, "Distance (mi)" AS distance_mi,
           {O.ofloat('"Duration (s)"')} / 60 AS duration_min,
           {O.ofloat('"Distance (mi)"')} * 1609.34 AS distance_m
    FROM ({TD.moves_activities_sql(D)}) a""")
def unit_convert(spark):
    r = TD.raw_moves_activities(spark)
    return r.select(F.col("Duration (s)").alias("duration_s"), F.col("Distance (mi)").alias("distance_mi"),
                    (V.float_prefix("Duration (s)") / 60).alias("duration_min"),
                    (V.float_prefix("Distance (mi)") * 1609.34).alias("distance_m"))


@q("confidence_source", lambda: f"""
    SELECT device_name, confidence, count(*) AS records
    FROM ({ok(O.o_apple_records())}) t GROUP BY 1, 2""")
def confidence_source(spark):
    r = recs(spark, "apple").filter(F.col("sub_type") != "workout")
    conf = F.coalesce(*[mc(k) for k in ["steps", "heart_rate", "weight", "bp_systolic",
                                         "metric_value", "distance", "calories",
                                         "resting_heart_rate", "bp_diastolic"]])
    return r.groupBy(at("device_name").alias("device_name"), conf.alias("confidence")).agg(
        F.count(F.lit(1)).alias("records"))


@q("severity_map", lambda: f"""
    SELECT severity, severity_score, count(*) AS records
    FROM ({ok(O.o_manual()['migraine'])}) t GROUP BY 1, 2""")
def severity_map(spark):
    return recs(spark, "manual_migraine").groupBy(
        at("severity").alias("severity"), mv("severity_score").alias("severity_score")).agg(
        F.count(F.lit(1)).alias("records"))


@q("habit_categorize", lambda: f"""
    SELECT habit_name, habit_category, count(*) AS records
    FROM ({ok(O.o_habits())}) t GROUP BY 1, 2""")
def habit_categorize(spark):
    return recs(spark, "habits").groupBy(
        at("habit_name").alias("habit_name"), at("habit_category").alias("habit_category")).agg(
        F.count(F.lit(1)).alias("records"))


@q("subtype_apple", lambda: f"""
    SELECT type, {O.apple_subtype_case('type')} AS sub_type, count(*) AS records
    FROM ({O.o_xml_attrs()}) x WHERE tag = 'Record' GROUP BY 1, 2""")
def subtype_apple(spark):
    from vitaldf.sources import apple
    e = apple.with_attributes(TD.raw_xml(spark)).filter(F.col("tag") == "Record")
    t = F.col("attrs")["type"]
    return e.groupBy(t.alias("type"), V.subtype_apple(t).alias("sub_type")).agg(
        F.count(F.lit(1)).alias("records"))


@q("datatype_apple", lambda: f"""
    SELECT type, {O.apple_type_case('type')} AS data_type, count(*) AS records
    FROM ({O.o_xml_attrs()}) x WHERE tag = 'Record' GROUP BY 1, 2""")
def datatype_apple(spark):
    from vitaldf.sources import apple
    e = apple.with_attributes(TD.raw_xml(spark)).filter(F.col("tag") == "Record")
    t = F.col("attrs")["type"]
    return e.groupBy(t.alias("type"), V.datatype_apple(t).alias("data_type")).agg(
        F.count(F.lit(1)).alias("records"))


# ------------------------------------------------------------- fields ------

@q("coalesce_nonblank", lambda: f"""
    SELECT {O.orender('ts')} AS timestamp, rhr AS resting_heart_rate
    FROM ({ok(O.o_gyro_vitals())}) t WHERE sub_type = 'rhr'""")
def coalesce_nonblank(spark):
    r = recs(spark, "gyro_vitals").filter(F.col("sub_type") == "rhr")
    return r.select(ts_out().alias("timestamp"), mv("resting_heart_rate").alias("resting_heart_rate"))


@q("first_present_column", lambda: f"""
    SELECT primary_symptom, severity, severity_score, duration, duration_unit
    FROM ({ok(O.o_manual()['symptoms'])}) t""")
def first_present_column(spark):
    r = recs(spark, "manual_symptoms")
    return r.select(at("primary_symptom").alias("primary_symptom"), at("severity").alias("severity"),
                    mv("severity_score").alias("severity_score"), mv("duration").alias("duration"),
                    mu("duration").alias("duration_unit"))


@q("first_matching_column", lambda: f"""
    SELECT {O.orender('ts')} AS timestamp, hours_slept, hours_slept_unit, score__, score___unit
    FROM ({ok(O.o_sleep_generic())}) t""")
def first_matching_column(spark):
    r = recs(spark, "sleep_generic")
    return r.select(ts_out().alias("timestamp"), mv("hours_slept").alias("hours_slept"),
                    mu("hours_slept").alias("hours_slept_unit"), mv("score__").alias("score__"),
                    mu("score__").alias("score___unit"))


@q("fields_to_metrics", lambda: f"""
    SELECT {O.orender('ts')} AS timestamp, energy, steps_walked, note_text
    FROM ({ok(O.o_manual()['general'])}) t""")
def fields_to_metrics(spark):
    r = recs(spark, "manual_general")
    return r.select(ts_out().alias("timestamp"), mv("energy").alias("energy"),
                    mv("steps_walked").alias("steps_walked"), at("note_text").alias("note_text"))


@q("xml_attributes", lambda: f"""
    SELECT tag, type, source_name, value, start_date FROM ({O.o_xml_attrs()}) x""")
def xml_attributes(spark):
    e = TD.raw_xml(spark).withColumn("a", V.xml_attributes("line"))
    return e.select("tag", F.col("a")["type"].alias("type"),
                    F.col("a")["sourceName"].alias("source_name"),
                    F.col("a")["value"].alias("value"), F.col("a")["startDate"].alias("start_date"))


@q("array_explode_minutes", lambda: f"""
    SELECT origin, minute_offset, value FROM ({O.o_nike_minutes()}) t""")
def array_explode_minutes(spark):
    from vitaldf.sources import nike
    raw = TD.raw_minutes(spark)
    fname = V.file_name(F.col("origin"))
    d = raw.withColumns({"__date": F.regexp_extract(fname, r"NikePlus-(\d{4}-\d{2}-\d{2})", 1),
                         "__act": F.lit(None), "__base": F.lit(None)})
    x = nike.explode_minutes(d)
    return x.select("origin", F.col("__offset").alias("minute_offset"),
                    V.float_prefix(F.col("__val")).alias("value"))


@q("array_explode_segments", lambda: f"""
    SELECT sub_type, {O.orender('ts')} AS timestamp, place_name, activity_type
    FROM ({ok(O.o_storyline_json())}) t""")
def array_explode_segments(spark):
    r = recs(spark, "moves_storyline_json")
    return r.select("sub_type", ts_out().alias("timestamp"), at("place_name").alias("place_name"),
                    at("activity_type").alias("activity_type"))


@q("json_struct_access", lambda: f"""
    SELECT place_name, category, latitude, longitude FROM ({ok(O.o_moves_places_json())}) t""")
def json_struct_access(spark):
    r = recs(spark, "moves_places_json")
    return r.select(at("place_name").alias("place_name"), at("category").alias("category"),
                    F.col("location.latitude").alias("latitude"),
                    F.col("location.longitude").alias("longitude"))


@q("json_serialize_raw", lambda: f"""
    SELECT to_json({{'date': date, 'steps': steps, 'service': service}})::VARCHAR AS raw_data
    FROM ({TD.steps_sql(D)}) a""")
def json_serialize_raw(spark):
    return recs(spark, "gyro_steps").select("raw_data")


@q("array_to_json", lambda: f"""
    SELECT to_json([primary_symptom])::VARCHAR AS symptoms_json
    FROM ({ok(O.o_manual()['symptoms'])}) t""")
def array_to_json(spark):
    return TB.map_symptoms(recs(spark, "manual_symptoms")).select("symptoms_json")


@q("record_id", lambda: f"""
    WITH a AS (SELECT *, to_json({{'date': date, 'steps': steps, 'service': service}})::VARCHAR AS raw,
                      row_number() OVER (PARTITION BY origin, date, steps, service) AS occ
               FROM ({TD.steps_sql(D)}) s)
    SELECT sha256(concat_ws(chr(31), 'gyroscope', origin, 'steps', date, raw, CAST(occ AS VARCHAR))) AS id
    FROM a""")
def record_id(spark):
    return recs(spark, "gyro_steps").select("id")
