"""Health records -> relational tables (parent + typed detail tables).

Each table is a filtered projection of the record DataFrame (with the columns
``extra`` of the records beside its own, where given).  When the records are
stored partitioned by ``data_type`` the filters prune whole partitions, so
each detail table reads only its own slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaldf.functions import (attr, barrier, m, metric_confidence, metric_unit, metric_value,
                               or_default, time_of)


def _dt(name: str) -> Column:
    return F.col("data_type") == name


def _minutes(metric_col: Column) -> Column:
    """Duration metric converted to minutes by its unit."""
    u = F.lower(metric_unit(metric_col))
    v = metric_value(metric_col)
    return (F.when(u.isin("hours", "hour", "hr", "h"), v * 60)
            .when(u.isin("seconds", "second", "sec", "s"), v / 60)
            .otherwise(v))


def _hours(metric_col: Column) -> Column:
    u = F.lower(metric_unit(metric_col))
    v = metric_value(metric_col)
    return (F.when(u.isin("minutes", "minute", "min"), v / 60)
            .when(u.isin("seconds", "second", "sec", "s"), v / 3600)
            .otherwise(v))


#: columns of the records that the parent table holds under their own names
PARENT_COLS = ("id", "timestamp", "date_only", "source", "data_type", "sub_type", "processed_at")


def map_health_records(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return records.select(
        *PARENT_COLS, F.coalesce(F.col("raw_data"), F.lit("{}")).alias("raw_data"),
        F.col("processed_at").alias("created_at"), *extra)


def map_fitness(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return records.filter(_dt("fitness")).select(
        F.col("id").alias("record_id"),
        metric_value(m("steps")).alias("steps"),
        metric_unit(m("steps"), "steps").alias("steps_unit"),
        metric_confidence(m("steps")).alias("steps_confidence"),
        metric_value(m("calories")).alias("calories"),
        metric_unit(m("calories"), "calories").alias("calories_unit"),
        metric_confidence(m("calories")).alias("calories_confidence"),
        metric_value(m("distance")).alias("distance"),
        metric_unit(m("distance")).alias("distance_unit"),
        metric_confidence(m("distance")).alias("distance_confidence"),
        _minutes(m("duration")).alias("duration_minutes"),
        metric_confidence(m("duration")).alias("duration_confidence"),
        attr("workout_type").alias("workout_type"),
        F.when(attr("workout_name") != "", attr("workout_name")).alias("workout_name"),
        metric_value(m("fuel_points")).alias("fuel_points"),
        metric_confidence(m("fuel_points")).alias("fuel_confidence"),
        time_of("start_time").alias("start_time"),
        time_of("end_time").alias("end_time"),
        F.coalesce(attr("activity_id"), attr("workout_id")).alias("activity_id"),
        *extra,
    )


def map_vitals(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    sys_m = m("bp_systolic")
    return records.filter(_dt("health")).select(
        F.col("id").alias("record_id"),
        metric_value(m("heart_rate")).alias("heart_rate"),
        metric_unit(m("heart_rate"), "bpm").alias("heart_rate_unit"),
        metric_confidence(m("heart_rate")).alias("heart_rate_confidence"),
        metric_value(m("resting_heart_rate")).alias("resting_heart_rate"),
        metric_unit(m("resting_heart_rate"), "bpm").alias("resting_hr_unit"),
        metric_confidence(m("resting_heart_rate")).alias("resting_hr_confidence"),
        metric_value(m("heart_rate_variability")).alias("heart_rate_variability"),
        metric_unit(m("heart_rate_variability"), "ms").alias("hrv_unit"),
        metric_confidence(m("heart_rate_variability")).alias("hrv_confidence"),
        metric_value(sys_m).alias("systolic_bp"),
        metric_value(m("bp_diastolic")).alias("diastolic_bp"),
        F.when(sys_m.isNotNull(), metric_unit(sys_m, "mmHg")).otherwise(F.lit("mmHg")).alias("bp_unit"),
        metric_confidence(sys_m).alias("bp_confidence"),
        metric_value(m("glucose")).alias("glucose"),
        metric_unit(m("glucose"), "mg/dL").alias("glucose_unit"),
        metric_confidence(m("glucose")).alias("glucose_confidence"),
        metric_value(m("weight")).alias("weight"),
        metric_unit(m("weight")).alias("weight_unit"),
        metric_confidence(m("weight")).alias("weight_confidence"),
        metric_value(m("bmi")).alias("bmi"),
        metric_confidence(m("bmi")).alias("bmi_confidence"),
        metric_value(m("oxygen_saturation")).alias("oxygen_saturation"),
        metric_unit(m("oxygen_saturation"), "percent").alias("oxygen_unit"),
        metric_confidence(m("oxygen_saturation")).alias("oxygen_confidence"),
        metric_value(m("body_temperature")).alias("body_temperature"),
        metric_unit(m("body_temperature")).alias("temperature_unit"),
        metric_confidence(m("body_temperature")).alias("temperature_confidence"),
        attr("device_name").alias("device_name"),
        attr("measurement_source").alias("measurement_source"),
        *extra,
    )


def map_sleep(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    awake = F.coalesce(m("awake_time"), m("awake_minutes"))
    return records.filter(_dt("sleep")).select(
        F.col("id").alias("record_id"),
        time_of("bedtime").alias("bedtime"),
        time_of("sleep_start").alias("sleep_start"),
        time_of("sleep_end").alias("sleep_end"),
        time_of("wake_time").alias("wake_time"),
        metric_value(m("sleep_duration")).alias("sleep_duration_minutes"),
        metric_confidence(m("sleep_duration")).alias("duration_confidence"),
        metric_value(m("time_in_bed")).alias("time_in_bed_minutes"),
        metric_confidence(m("time_in_bed")).alias("bed_time_confidence"),
        metric_value(m("sleep_efficiency")).alias("sleep_efficiency"),
        metric_confidence(m("sleep_efficiency")).alias("efficiency_confidence"),
        metric_value(m("sleep_quality")).alias("sleep_quality"),
        metric_confidence(m("sleep_quality")).alias("quality_confidence"),
        metric_value(m("deep_sleep")).alias("deep_sleep_minutes"),
        metric_value(m("light_sleep")).alias("light_sleep_minutes"),
        metric_value(m("rem_sleep")).alias("rem_sleep_minutes"),
        metric_value(awake).alias("awake_minutes"),
        metric_value(m("wake_ups")).cast("bigint").alias("wake_ups"),
        metric_value(m("time_to_sleep")).alias("time_to_sleep_minutes"),
        attr("wake_mood").alias("wake_mood"),
        attr("sleep_notes").alias("sleep_notes"),
        attr("measurement_source").alias("measurement_source"),
        *extra,
    )


def map_habits(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return records.filter(_dt("habits")).select(
        F.col("id").alias("record_id"),
        attr("habit_id").alias("habit_id"),
        F.coalesce(F.when(attr("habit_name") != "", attr("habit_name")),
                   F.lit("Unknown")).alias("habit_name"),
        F.coalesce(attr("habit_category"), F.lit("other")).alias("habit_category"),
        F.coalesce(F.to_date(time_of("checkin_date")), F.col("date_only")).alias("checkin_date"),
        or_default(metric_value(m("checkin_count")), 1).cast("bigint").alias("checkin_count"),
        or_default(metric_value(m("streak_days")), 0).cast("bigint").alias("streak_days"),
        or_default(metric_value(m("prop_count")), 0).cast("bigint").alias("prop_count"),
        or_default(metric_value(m("comment_count")), 0).cast("bigint").alias("comment_count"),
        F.coalesce(attr("completed").cast("boolean"), F.lit(True)).alias("completed"),
        or_default(metric_confidence(m("completion_confidence")), 1.0).alias("completion_confidence"),
        F.when(attr("notes") != "", attr("notes")).alias("notes"),
        F.coalesce(attr("coach_me_url"), attr("external_url")).alias("external_url"),
        *extra,
    )


def _having(records: DataFrame, cond: Column) -> DataFrame:
    """Records for which ``cond`` holds, read from their finished maps.

    Pushed into the layouts, it would copy the code of every map it reads.
    """
    return records.withColumn("__having", barrier(cond)).filter("__having")


def has_symptom(records_col_free: bool = True) -> Column:
    """Records that describe a condition, symptoms, a severity or pain."""
    return (attr("condition").isNotNull() | F.col("symptoms").isNotNull()
            | attr("severity").isNotNull() | attr("pain_location").isNotNull()
            | m("pain_intensity").isNotNull())


def map_symptoms(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return _having(records, has_symptom()).select(
        F.col("id").alias("record_id"),
        attr("condition").alias("condition"),
        attr("primary_symptom").alias("primary_symptom"),
        F.when(F.col("symptoms").isNotNull(), F.to_json(F.col("symptoms"))).alias("symptoms_json"),
        attr("severity").alias("severity"),
        metric_value(m("severity_score")).alias("severity_score"),
        metric_confidence(m("severity_score")).alias("severity_confidence"),
        _hours(m("duration")).alias("duration_hours"),
        metric_confidence(m("duration")).alias("duration_confidence"),
        attr("pain_location").alias("pain_location"),
        metric_value(m("pain_intensity")).alias("pain_intensity"),
        metric_confidence(m("pain_intensity")).alias("pain_confidence"),
        F.coalesce(attr("impact_level"), attr("severity")).alias("impact_level"),
        F.when(attr("notes") != "", attr("notes")).alias("notes"),
        F.coalesce(attr("medication_taken").cast("boolean"), F.lit(False)).alias("medication_taken"),
        *extra,
    )


def has_medication() -> Column:
    return attr("medication_name").isNotNull()


def map_medications(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return _having(records, has_medication()).select(
        F.col("id").alias("record_id"),
        attr("medication_name").alias("medication_name"),
        metric_value(m("dosage")).alias("dosage_value"),
        metric_unit(m("dosage")).alias("dosage_unit"),
        metric_confidence(m("dosage")).alias("dosage_confidence"),
        attr("frequency").alias("frequency"),
        F.col("timestamp").alias("taken_at"),
        F.when(attr("notes") != "", attr("notes")).alias("notes"),
        *extra,
    )


def map_locations(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    loc = F.col("location")
    visit = F.coalesce(m("visit_duration"), m("duration"))
    return records.filter(_dt("location")).select(
        F.col("id").alias("record_id"),
        loc.getField("latitude").alias("latitude"),
        loc.getField("longitude").alias("longitude"),
        F.coalesce(F.when(loc.getField("name") != "", loc.getField("name")),
                   attr("place_name")).alias("location_name"),
        F.coalesce(time_of("visit_start"), time_of("arrival_time"),
                   time_of("start_time")).alias("visit_start"),
        F.coalesce(time_of("visit_end"), time_of("departure_time"),
                   time_of("end_time")).alias("visit_end"),
        metric_value(visit).alias("visit_duration"),
        metric_unit(visit, "minutes").alias("visit_duration_unit"),
        metric_confidence(visit).alias("visit_duration_confidence"),
        attr("measurement_source").alias("measurement_source"),
        *extra,
    )


def drop_empty_detail(table: DataFrame, key: str = "record_id") -> DataFrame:
    """Keep detail rows where at least one non-key field holds data."""
    others = [c for c in table.columns if c != key]
    return table.filter(F.coalesce(*[F.col(c).cast("string") for c in others]).isNotNull())


MAPPERS = {
    "health_records": map_health_records,
    "fitness_metrics": map_fitness,
    "health_vitals": map_vitals,
    "sleep_sessions": map_sleep,
    "habits": map_habits,
    "symptoms": map_symptoms,
    "medications": map_medications,
    "location_data": map_locations,
}


#: the data type of the records that a table is made from, where there is one
DATA_TYPE_OF = {"fitness_metrics": "fitness", "health_vitals": "health", "sleep_sessions": "sleep",
                "habits": "habits", "location_data": "location"}


class LazyTables(Mapping):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, build: Mapping[str, Callable[[], DataFrame]]):
        self._build, self._built = dict(build), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)


class RoutedTables(LazyTables):
    """The tables of ``records``, which also tell what they hold in one pass over the records.

    A table is a projection of the records that meet its condition, so that
    counting them needs neither the projection nor a scan for each table.
    """

    def __init__(self, records: DataFrame, extra: Sequence[str] = ()):
        def build(name):
            own = [c for c in extra if name != "health_records" or c not in PARENT_COLS]
            return MAPPERS[name](records, own)
        super().__init__({name: (lambda name=name: build(name)) for name in MAPPERS})
        self.records, self.extra = records, tuple(extra)

    def condition(self, name: str) -> Column:
        """Which records have a row in the table (never null)."""
        if name in DATA_TYPE_OF:
            return F.coalesce(_dt(DATA_TYPE_OF[name]), F.lit(False))
        return {"symptoms": has_symptom, "medications": has_medication}.get(name, lambda: F.lit(True))()

    def details(self) -> list[str]:
        return [name for name in self if name != "health_records"]

    def detail_ids(self) -> DataFrame:
        """(record_id, tables) of every record that has detail rows: one in each of ``tables``."""
        names = F.array_compact(F.array(*[F.when(self.condition(n), F.lit(n)) for n in self.details()]))
        # (read from finished maps, see _having)
        return self.records.select(F.col("id").alias("record_id"), barrier(names).alias("tables")).filter(
            F.size("tables") > 0)

    def row_counts(self) -> dict[str, Column]:
        """Aggregates over the records: each table's number of rows."""
        return {name: F.count_if(self.condition(name)) for name in self}


def route_records(records: DataFrame, extra: Sequence[str] = ()) -> RoutedTables:
    """Parent + every detail table (with the columns ``extra``) as lazily derived DataFrames."""
    return RoutedTables(records, extra)
