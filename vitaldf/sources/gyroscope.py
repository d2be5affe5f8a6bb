"""Activity-app CSV exports (`gyroscope-<user>-<type>-export.csv`).

One projection handles every file type: the type comes from the file name
(a row-level value), so routing is a `when` chain instead of one scan per
type.  Header-level choices (which columns exist) are made at plan time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaldf import functions as V
from vitaldf.operators.records import header_cols, pre_record, with_occurrence, with_raw_json
from vitaldf.schema import GYRO_TS_FIELDS

SOURCE = "gyroscope"
WORKOUT_TYPES = ("workouts", "running", "cycling")


def union_raw(frames: list[DataFrame]) -> DataFrame:
    """Bag union of activity-app files with different headers.

    Every header-level choice here is either value-level (first non-blank
    of the timestamp columns) or needs both columns present, so files of all
    types can share one plan: a missing column reads as NULL.
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def normalize(raw: DataFrame) -> DataFrame:
    """Raw rows (header columns + ``origin``) -> pre-records."""
    cols = header_cols(raw)
    df = with_raw_json(with_occurrence(raw), cols)

    def c(name):
        return V.col_or_null(cols, name)

    def dur(a, b):
        """Minutes between two header columns (NULL when one is absent)."""
        if a in cols and b in cols:
            return V.duration_minutes(a, b)
        return F.lit(None).cast("bigint")

    def nb(name):
        return V.blank_to_null(c(name))

    # found once a row: much below asks for it
    df = df.withColumn("__sub", V.gyro_sub_type(F.col("origin")))
    sub = F.col("__sub")
    route = (F.when(sub == "steps", "steps").when(sub == "sleep", "sleep")
             .when(sub.isin(*WORKOUT_TYPES), "workout").otherwise("health"))
    ts_text = V.coalesce_nonblank(*[c(n) for n in GYRO_TS_FIELDS])
    data_type = (F.when(route == "steps", "fitness").when(route == "sleep", "sleep")
                 .when(route == "workout", "fitness")
                 .when(sub == "gvisits", "location").otherwise("health"))

    # workouts / sleep read start_time/end_time; "Start Time" headers are used
    # where start_time is absent (visits and some workout exports).
    df = df.withColumns({"__start": V.coalesce_nonblank(c("start_time"), c("Start Time")),
                         "__end": V.coalesce_nonblank(c("end_time"), c("End Time"))})
    start, end = F.col("__start"), F.col("__end")
    minutes = V.duration_minutes("__start", "__end")

    systolic = V.float_prefix(nb("systolic"))
    diastolic = V.float_prefix(nb("diastolic"))
    bp_ok = (route == "health") & (sub == "bp") & (systolic > 0) & (diastolic > 0)
    rhr_text = V.coalesce_nonblank(c("rhr"), c("heart_rate"))
    visit_ok = (sub == "gvisits") & nb("Start Time").isNotNull() & nb("End Time").isNotNull()
    is_health = route == "health"

    metrics = {
        "steps": V.metric_when(route == "steps", V.or_default(V.int_prefix(c("steps")), 0),
                               "steps", V.confidence_service(c("service"))),
        "sleep_duration": V.metric_when(route == "sleep", dur("start_time", "end_time"),
                                        "minutes", 0.8),
        "duration": V.metric_when(route == "workout", minutes, "minutes", 0.8),
        "calories": V.metric_when((route == "workout") & nb("calories").isNotNull(),
                                  V.float_prefix(c("calories")), "calories", 0.7),
        "bp_systolic": V.metric_when(bp_ok, systolic, "mmHg", 0.8),
        "bp_diastolic": V.metric_when(bp_ok, diastolic, "mmHg", 0.8),
        "glucose": V.metric_when(is_health & (sub == "glucose") & nb("glucose").isNotNull(),
                                 V.float_prefix(c("glucose")), "mg/dL", 0.8),
        "heart_rate_variability": V.metric_when(
            is_health & (sub == "hrv") & nb("hrv").isNotNull(),
            V.float_prefix(c("hrv")), "ms", 0.8),
        "resting_heart_rate": V.metric_when(is_health & (sub == "rhr") & rhr_text.isNotNull(),
                                            V.float_prefix(rhr_text), "bpm", 0.8),
        "visit_duration": V.metric_when(is_health & visit_ok, dur("Start Time", "End Time"),
                                        "minutes", 0.8),
    }
    attrs = {
        "measurement_source": F.when(is_health, F.coalesce(nb("service"), F.lit("gyroscope")))
                               .otherwise(c("service")),
        "workout_id": F.when(route == "workout", c("id")),
        "workout_type": F.when(route == "workout", F.coalesce(nb("type"), F.lit("unknown"))),
        "workout_name": F.when(route == "workout", F.coalesce(nb("name"), F.lit(""))),
        "mood_score": F.when(is_health & (sub == "mood"), c("mood")),
        "notes": F.when(is_health & (sub == "mood"), F.coalesce(nb("notes"), F.lit(""))),
    }
    times = {
        "sleep_start": F.when(route == "sleep", c("start_time")),
        "sleep_end": F.when(route == "sleep", c("end_time")),
        "start_time": F.when(route == "workout", start),
        "end_time": F.when(route == "workout", end),
        "visit_start": F.when(is_health & visit_ok, c("Start Time")),
        "visit_end": F.when(is_health & visit_ok, c("End Time")),
    }
    loc = F.when(is_health & (sub == "gvisits"), V.location(
        F.coalesce(nb("Name"), nb("name"), F.lit("")),
        V.float_prefix(nb("Latitude")), V.float_prefix(nb("Longitude"))))
    return df.select(*pre_record(SOURCE, data_type, sub, ts_text, metrics, attrs, times,
                                 loc=loc))
