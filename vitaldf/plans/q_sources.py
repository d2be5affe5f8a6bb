"""Queries for the source normalisers (survey §2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitaldf.plans import oracle as O
from vitaldf.plans.registry import (MANUAL, SLEEP, at, day_out, mc, mu, mv, q,
                                    recs, tm, ts_out)


def ok(sql: str) -> str:
    return f"SELECT * FROM ({sql}) t WHERE ts IS NOT NULL"


def R(x: str) -> str:
    return O.orender(x)


def _ts():
    return ts_out().alias("timestamp")


@q("base_record", lambda: f"""
    SELECT {R('ts')} AS timestamp, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date_only,
           source, data_type, sub_type FROM ({ok(O.o_gyro_steps())}) t""")
def base_record(spark):
    return recs(spark, "gyro_steps").select(_ts(), day_out().alias("date_only"), "source",
                                            "data_type", "sub_type")


def _gyro_core_sql():
    parts = [O.o_gyro_steps(), O.o_gyro_vitals(), O.o_gyro_visits(), O.o_gyro_workouts(),
             O.o_gyro_sleep()]
    u = " UNION ALL ".join(f"SELECT origin, sub_type, data_type, ts FROM ({p}) p" for p in parts)
    return f"SELECT origin, sub_type, data_type, {R('ts')} AS timestamp FROM ({u}) u WHERE ts IS NOT NULL"


@q("norm_gyro_route", _gyro_core_sql)
def norm_gyro_route(spark):
    return recs(spark, "gyro_all").select("origin", "sub_type", "data_type", _ts())


@q("norm_gyro_steps", lambda: f"""
    SELECT {R('ts')} AS timestamp, steps, steps_confidence, measurement_source
    FROM ({ok(O.o_gyro_steps())}) t""")
def norm_gyro_steps(spark):
    return recs(spark, "gyro_steps").select(_ts(), mv("steps").alias("steps"),
                                            mc("steps").alias("steps_confidence"),
                                            at("measurement_source").alias("measurement_source"))


@q("norm_gyro_sleep", lambda: f"""
    SELECT {R('ts')} AS timestamp, CAST(sleep_duration AS DOUBLE) AS sleep_duration,
           {R('sleep_start')} AS sleep_start, {R('sleep_end')} AS sleep_end, measurement_source
    FROM ({ok(O.o_gyro_sleep())}) t""")
def norm_gyro_sleep(spark):
    return recs(spark, "gyro_sleep").select(_ts(), mv("sleep_duration").alias("sleep_duration"),
                                            tm("sleep_start").alias("sleep_start"),
                                            tm("sleep_end").alias("sleep_end"),
                                            at("measurement_source").alias("measurement_source"))


@q("norm_gyro_workout", lambda: f"""
    SELECT {R('ts')} AS timestamp, sub_type, workout_id, workout_type, workout_name,
           CAST(duration AS DOUBLE) AS duration, calories,
           {R('start_time')} AS start_time, {R('end_time')} AS end_time
    FROM ({ok(O.o_gyro_workouts())}) t""")
def norm_gyro_workout(spark):
    return recs(spark, "gyro_workouts").select(
        _ts(), "sub_type", at("workout_id").alias("workout_id"), at("workout_type").alias("workout_type"),
        at("workout_name").alias("workout_name"), mv("duration").alias("duration"),
        mv("calories").alias("calories"), tm("start_time").alias("start_time"),
        tm("end_time").alias("end_time"))


@q("norm_gyro_vitals", lambda: f"""
    SELECT {R('ts')} AS timestamp, sub_type, systolic, diastolic, glucose, hrv, rhr,
           mood AS mood_score, measurement_source
    FROM ({ok(O.o_gyro_vitals())}) t""")
def norm_gyro_vitals(spark):
    return recs(spark, "gyro_vitals").select(
        _ts(), "sub_type", mv("bp_systolic").alias("systolic"), mv("bp_diastolic").alias("diastolic"),
        mv("glucose").alias("glucose"), mv("heart_rate_variability").alias("hrv"),
        mv("resting_heart_rate").alias("rhr"), at("mood_score").alias("mood_score"),
        at("measurement_source").alias("measurement_source"))


@q("norm_gyro_visits", lambda: f"""
    SELECT {R('ts')} AS timestamp, data_type, location_name, latitude, longitude,
           {R('visit_start')} AS visit_start, {R('visit_end')} AS visit_end,
           CAST(visit_duration AS DOUBLE) AS visit_duration
    FROM ({ok(O.o_gyro_visits())}) t""")
def norm_gyro_visits(spark):
    return recs(spark, "gyro_visits").select(
        _ts(), "data_type", F.col("location.name").alias("location_name"),
        F.col("location.latitude").alias("latitude"), F.col("location.longitude").alias("longitude"),
        tm("visit_start").alias("visit_start"), tm("visit_end").alias("visit_end"),
        mv("visit_duration").alias("visit_duration"))


_APPLE_VALUE_KEYS = ["steps", "distance", "calories", "heart_rate", "resting_heart_rate",
                     "bp_systolic", "bp_diastolic", "weight", "metric_value"]


@q("norm_apple_record", lambda: f"""
    SELECT {R('ts')} AS timestamp, data_type, sub_type, metric_name, value, unit, confidence,
           CAST(duration AS DOUBLE) AS duration, {R('end_time')} AS end_time, device_name
    FROM ({ok(O.o_apple_records())}) t""")
def norm_apple_record(spark):
    r = recs(spark, "apple").filter(F.col("sub_type") != "workout")
    key = F.element_at(F.filter(F.map_keys("metrics"),
                                lambda k: k.isin(*_APPLE_VALUE_KEYS)), 1)
    m = F.col("metrics")[key]
    return r.select(_ts(), "data_type", "sub_type", key.alias("metric_name"),
                    m["value"].alias("value"), m["unit"].alias("unit"),
                    m["confidence"].alias("confidence"), mv("duration").alias("duration"),
                    tm("end_time").alias("end_time"), at("device_name").alias("device_name"))


@q("norm_apple_workout", lambda: f"""
    SELECT {R('ts')} AS timestamp, workout_type, duration, duration_unit, calories, distance,
           {R('end_time')} AS end_time
    FROM ({ok(O.o_apple_workouts())}) t""")
def norm_apple_workout(spark):
    r = recs(spark, "apple").filter(F.col("sub_type") == "workout")
    return r.select(_ts(), at("workout_type").alias("workout_type"), mv("duration").alias("duration"),
                    mu("duration").alias("duration_unit"), mv("calories").alias("calories"),
                    mv("distance").alias("distance"), tm("end_time").alias("end_time"))


@q("norm_nike_summary", lambda: f"""
    SELECT origin, {R('ts')} AS timestamp, activity_id, activity_type, steps, calories,
           distance, fuel_points, duration FROM ({ok(O.o_nike_summary())}) t""")
def norm_nike_summary(spark):
    r = recs(spark, "nike").filter(F.col("sub_type") == "activity")
    return r.select(F.regexp_extract("origin", r"([^/]*)$", 1).alias("origin"), _ts(),
                    at("activity_id").alias("activity_id"), at("activity_type").alias("activity_type"),
                    mv("steps").alias("steps"), mv("calories").alias("calories"),
                    mv("distance").alias("distance"), mv("fuel_points").alias("fuel_points"),
                    mv("duration").alias("duration"))


@q("norm_nike_minutes", lambda: f"""
    SELECT {R('ts')} AS timestamp, sub_type, activity_id, CAST(minute_offset AS VARCHAR) AS minute_offset,
           value FROM ({ok(O.o_nike_minutes())}) t""")
def norm_nike_minutes(spark):
    r = recs(spark, "nike").filter(F.col("sub_type").startswith("minute_"))
    val = F.coalesce(mv("fuel_points"), mv("steps"), mv("calories"), mv("metric_value"))
    return r.select(_ts(), "sub_type", at("activity_id").alias("activity_id"),
                    at("minute_offset").alias("minute_offset"), val.alias("value"))


@q("norm_coach_habit", lambda: f"""
    SELECT {R('ts')} AS timestamp, habit_id, habit_name, habit_category, checkin_count,
           streak_days, prop_count, comment_count, notes FROM ({ok(O.o_habits())}) t""")
def norm_coach_habit(spark):
    return recs(spark, "habits").select(
        _ts(), at("habit_id").alias("habit_id"), at("habit_name").alias("habit_name"),
        at("habit_category").alias("habit_category"), mv("checkin_count").alias("checkin_count"),
        mv("streak_days").alias("streak_days"), mv("prop_count").alias("prop_count"),
        mv("comment_count").alias("comment_count"), at("notes").alias("notes"))


@q("norm_sleep_quality", lambda: f"""
    SELECT {R('ts')} AS timestamp, CAST(sleep_duration AS DOUBLE) AS sleep_duration, sleep_quality,
           time_in_bed, wake_mood, sleep_notes, {R('sleep_start')} AS sleep_start,
           {R('sleep_end')} AS sleep_end FROM ({ok(O.o_sleep_quality())}) t""")
def norm_sleep_quality(spark):
    return recs(spark, "sleep_quality").select(
        _ts(), mv("sleep_duration").alias("sleep_duration"), mv("sleep_quality").alias("sleep_quality"),
        mv("time_in_bed").alias("time_in_bed"), at("wake_mood").alias("wake_mood"),
        at("sleep_notes").alias("sleep_notes"), tm("sleep_start").alias("sleep_start"),
        tm("sleep_end").alias("sleep_end"))


@q("norm_sleep_simple", lambda: f"""
    SELECT {R('ts')} AS timestamp, CAST(sleep_duration AS DOUBLE) AS sleep_duration,
           measurement_source, {R('sleep_start')} AS sleep_start, {R('sleep_end')} AS sleep_end
    FROM ({ok(O.o_sleep_simple())}) t""")
def norm_sleep_simple(spark):
    return recs(spark, "sleep_simple").select(
        _ts(), mv("sleep_duration").alias("sleep_duration"),
        at("measurement_source").alias("measurement_source"),
        tm("sleep_start").alias("sleep_start"), tm("sleep_end").alias("sleep_end"))


_DET = ["sleep_duration", "sleep_efficiency", "deep_sleep", "rem_sleep", "awake_time", "wake_ups"]


@q("norm_sleep_detailed", lambda: f"""
    SELECT {R('ts')} AS timestamp, {', '.join(_DET)} FROM ({ok(O.o_sleep_detailed())}) t""")
def norm_sleep_detailed(spark):
    return recs(spark, "sleep_detailed").select(_ts(), *[mv(m).alias(m) for m in _DET])


@q("norm_sleep_generic", lambda: f"""
    SELECT {R('ts')} AS timestamp, hours_slept, score__ FROM ({ok(O.o_sleep_generic())}) t""")
def norm_sleep_generic(spark):
    return recs(spark, "sleep_generic").select(_ts(), mv("hours_slept").alias("hours_slept"),
                                               mv("score__").alias("score__"))


def _route_sql(parts):
    u = " UNION ALL ".join(f"SELECT origin, sub_type, ts FROM ({p}) p" for p in parts)
    return f"SELECT origin, sub_type, {R('ts')} AS timestamp FROM ({u}) u WHERE ts IS NOT NULL"


@q("norm_sleep_route", lambda: _route_sql([O.o_sleep_quality(), O.o_sleep_simple(),
                                           O.o_sleep_detailed(), O.o_sleep_generic()]))
def norm_sleep_route(spark):
    return recs(spark, *SLEEP).select("origin", "sub_type", _ts())


@q("norm_manual_route", lambda: _route_sql(list(O.o_manual().values())))
def norm_manual_route(spark):
    return recs(spark, *MANUAL).select("origin", "sub_type", _ts())


@q("norm_manual_migraine", lambda: f"""
    SELECT {R('ts')} AS timestamp, severity, severity_score, duration_hours, duration_minutes
    FROM ({ok(O.o_manual()['migraine'])}) t""")
def norm_manual_migraine(spark):
    return recs(spark, "manual_migraine").select(
        _ts(), at("severity").alias("severity"), mv("severity_score").alias("severity_score"),
        mv("duration").alias("duration_hours"), mv("duration_minutes").alias("duration_minutes"))


@q("norm_manual_symptom", lambda: f"""
    SELECT {R('ts')} AS timestamp, primary_symptom, severity, severity_score, duration
    FROM ({ok(O.o_manual()['symptoms'])}) t""")
def norm_manual_symptom(spark):
    return recs(spark, "manual_symptoms").select(
        _ts(), at("primary_symptom").alias("primary_symptom"), at("severity").alias("severity"),
        mv("severity_score").alias("severity_score"), mv("duration").alias("duration"))


@q("norm_manual_medication", lambda: f"""
    SELECT {R('ts')} AS timestamp, medication_name, dosage, dosage_unit, frequency
    FROM ({ok(O.o_manual()['medication'])}) t""")
def norm_manual_medication(spark):
    return recs(spark, "manual_medication").select(
        _ts(), at("medication_name").alias("medication_name"), mv("dosage").alias("dosage"),
        mu("dosage").alias("dosage_unit"), at("frequency").alias("frequency"))


@q("norm_manual_mood", lambda: f"""
    SELECT {R('ts')} AS timestamp, mood, mood_score FROM ({ok(O.o_manual()['mood'])}) t""")
def norm_manual_mood(spark):
    return recs(spark, "manual_mood").select(_ts(), at("mood").alias("mood"),
                                             mv("mood_score").alias("mood_score"))


@q("norm_manual_pain", lambda: f"""
    SELECT {R('ts')} AS timestamp, pain_location, pain_intensity
    FROM ({ok(O.o_manual()['pain'])}) t""")
def norm_manual_pain(spark):
    return recs(spark, "manual_pain").select(_ts(), at("pain_location").alias("pain_location"),
                                             mv("pain_intensity").alias("pain_intensity"))


@q("norm_manual_weight", lambda: f"""
    SELECT {R('ts')} AS timestamp, weight, CASE WHEN weight IS NOT NULL THEN weight_unit END AS weight_unit,
           bmi FROM ({ok(O.o_manual()['weight'])}) t""")
def norm_manual_weight(spark):
    return recs(spark, "manual_weight").select(_ts(), mv("weight").alias("weight"),
                                               mu("weight").alias("weight_unit"), mv("bmi").alias("bmi"))


@q("norm_manual_bp", lambda: f"""
    SELECT {R('ts')} AS timestamp, systolic, diastolic FROM ({ok(O.o_manual()['blood_pressure'])}) t""")
def norm_manual_bp(spark):
    return recs(spark, "manual_blood_pressure").select(_ts(), mv("bp_systolic").alias("systolic"),
                                                       mv("bp_diastolic").alias("diastolic"))


@q("norm_manual_glucose", lambda: f"""
    SELECT {R('ts')} AS timestamp, glucose FROM ({ok(O.o_manual()['glucose'])}) t""")
def norm_manual_glucose(spark):
    return recs(spark, "manual_glucose").select(_ts(), mv("glucose").alias("glucose"))


@q("norm_manual_general", lambda: f"""
    SELECT {R('ts')} AS timestamp, energy, steps_walked, note_text
    FROM ({ok(O.o_manual()['general'])}) t""")
def norm_manual_general(spark):
    return recs(spark, "manual_general").select(_ts(), mv("energy").alias("energy"),
                                                mv("steps_walked").alias("steps_walked"),
                                                at("note_text").alias("note_text"))


@q("norm_moves_activity", lambda: f"""
    SELECT {R('ts')} AS timestamp, activity_type, activity_group, duration, distance, steps, calories
    FROM ({ok(O.o_moves_activities())}) t""")
def norm_moves_activity(spark):
    return recs(spark, "moves_activities").select(
        _ts(), at("activity_type").alias("activity_type"), at("activity_group").alias("activity_group"),
        mv("duration").alias("duration"), mv("distance").alias("distance"),
        mv("steps").alias("steps"), mv("calories").alias("calories"))


@q("norm_moves_place", lambda: f"""
    SELECT {R('ts')} AS timestamp, place_name, category, latitude, longitude, visit_duration,
           external_link FROM ({ok(O.o_moves_places())}) t""")
def norm_moves_place(spark):
    return recs(spark, "moves_places").select(
        _ts(), at("place_name").alias("place_name"), at("category").alias("category"),
        F.col("location.latitude").alias("latitude"), F.col("location.longitude").alias("longitude"),
        mv("visit_duration").alias("visit_duration"), at("external_link").alias("external_link"))


@q("norm_moves_storyline", lambda: f"""
    SELECT {R('ts')} AS timestamp, data_type, sub_type, duration, visit_duration, place_name
    FROM ({ok(O.o_moves_storyline_csv())}) t""")
def norm_moves_storyline(spark):
    return recs(spark, "moves_storyline_csv").select(
        _ts(), "data_type", "sub_type", mv("duration").alias("duration"),
        mv("visit_duration").alias("visit_duration"), at("place_name").alias("place_name"))


@q("norm_moves_summary", lambda: f"""
    SELECT {R('ts')} AS timestamp, steps, distance, calories, active_duration
    FROM ({ok(O.o_moves_summary())}) t""")
def norm_moves_summary(spark):
    return recs(spark, "moves_summary").select(
        _ts(), mv("steps").alias("steps"), mv("distance").alias("distance"),
        mv("calories").alias("calories"), mv("active_duration").alias("active_duration"))


@q("norm_moves_generic", lambda: f"""
    SELECT {R('ts')} AS timestamp, data_type, sub_type FROM ({ok(O.o_moves_generic())}) t""")
def norm_moves_generic(spark):
    return recs(spark, "moves_generic").select(_ts(), "data_type", "sub_type")


@q("norm_moves_activity_json", lambda: f"""
    SELECT {R('ts')} AS timestamp, activity_type, duration, distance
    FROM ({ok(O.o_moves_json_activities())}) t""")
def norm_moves_activity_json(spark):
    return recs(spark, "moves_json_activities").select(
        _ts(), at("activity_type").alias("activity_type"), mv("duration").alias("duration"),
        mv("distance").alias("distance"))


@q("norm_moves_place_json", lambda: f"""
    SELECT {R('ts')} AS timestamp, place_name, category, latitude, longitude
    FROM ({ok(O.o_moves_places_json())}) t""")
def norm_moves_place_json(spark):
    return recs(spark, "moves_places_json").select(
        _ts(), at("place_name").alias("place_name"), at("category").alias("category"),
        F.col("location.latitude").alias("latitude"), F.col("location.longitude").alias("longitude"))


@q("union_sources", lambda: f"""
    SELECT source, count(*) AS records FROM ({O.all_core()}) u WHERE ok GROUP BY source""")
def union_sources(spark):
    return recs(spark).groupBy("source").agg(F.count(F.lit(1)).alias("records"))
