"""Movement-app exports: CSV (activities, places, storyline, summary) and
JSON arrays (activities, places, storyline segments)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaldf import functions as V
from vitaldf.operators.records import (header_cols, pre_record, union_all,
                                       with_occurrence, with_raw_json)
from vitaldf.schema import MILES_TO_METRES
from vitaldf.sources import json_arrays

SOURCE = "moves"

PLACE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])),
])
ACTIVITY_ITEM = T.StructType([
    T.StructField("startTime", T.StringType()),
    T.StructField("endTime", T.StringType()),
    T.StructField("activity", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("distance", T.DoubleType()),
])
PLACE_ITEM = T.StructType([
    T.StructField("startTime", T.StringType()),
    T.StructField("endTime", T.StringType()),
    T.StructField("place", PLACE),
])
SEGMENT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("startTime", T.StringType()),
    T.StructField("endTime", T.StringType()),
    T.StructField("place", PLACE),
    T.StructField("activities", T.ArrayType(ACTIVITY_ITEM)),
])
STORYLINE_ITEM = T.StructType([T.StructField("segments", T.ArrayType(SEGMENT))])
JSON_SCHEMAS = {"activities": ACTIVITY_ITEM, "places": PLACE_ITEM, "storyline": STORYLINE_ITEM}

# Column aliases: the export writes units into some headers.
DURATION_COLS = ["Duration", "Duration (s)"]
DISTANCE_COLS = ["Distance", "Distance (mi)", "Distance (m)"]


def kind_of(path: str) -> str:
    base = path.rsplit("/", 1)[-1]
    for ext in (".csv", ".json"):
        if base.endswith(ext):
            return base[: -len(ext)]
    return base


# ---------------------------------------------------------------- CSV -------

def _csv_parts(cols):
    def c(name):
        return V.col_or_null(cols, name)

    def nb(name):
        return V.blank_to_null(c(name))

    dur = c(V.first_present_column(cols, DURATION_COLS))
    name = V.first_present_column(cols, DISTANCE_COLS)
    dist = c(name)
    # metres are kept as they are, miles (also when no unit is named) converted
    metres = V.float_prefix(dist) * (1.0 if name == "Distance (m)" else MILES_TO_METRES)
    return c, nb, dur, V.metric_when(V.blank_to_null(dist).isNotNull(), metres, "meters", 0.8)


def _activity(cols):
    c, nb, dur, dist = _csv_parts(cols)
    atype = F.coalesce(nb("Activity"), F.lit("unknown"))
    return dict(
        data_type="fitness", sub_type="activity", ts=c("Start"),
        metrics={
            "duration": V.metric_when(V.blank_to_null(dur).isNotNull(),
                                      V.float_prefix(dur) / 60, "minutes", 0.8),
            "distance": dist,
            "steps": V.metric_when(nb("Steps").isNotNull(), V.int_prefix(c("Steps")), "steps", 0.9),
            "calories": V.metric_when(nb("Calories").isNotNull(), V.float_prefix(c("Calories")),
                                      "calories", 0.7),
        },
        attrs={"activity_type": atype,
               "activity_group": F.coalesce(nb("Group"), atype),
               "measurement_source": F.lit("moves")},
        times={"start_time": c("Start"), "end_time": nb("End")},
        loc=None)


def _place(cols):
    c, nb, dur, _ = _csv_parts(cols)
    has_ll = nb("Latitude").isNotNull() & nb("Longitude").isNotNull()
    return dict(
        data_type="location", sub_type="location", ts=c("Start"),
        metrics={"visit_duration": V.metric_when(V.blank_to_null(dur).isNotNull(),
                                                 V.float_prefix(dur) / 60, "minutes", 0.9)},
        attrs={"place_name": c("Name"),
               "category": F.coalesce(nb("Category"), F.lit("unknown")),
               "external_link": F.when(F.trim(c("Link")) != "", c("Link")),
               "measurement_source": F.lit("moves")},
        times={"arrival_time": c("Start"), "departure_time": nb("End")},
        loc=F.when(has_ll, V.location(F.lit(None), V.float_prefix(c("Latitude")),
                                      V.float_prefix(c("Longitude")))))


def _storyline_plain(cols):
    c, nb, _, _ = _csv_parts(cols)
    return dict(data_type="location", sub_type="storyline", ts=c("Start"), metrics={},
                attrs={"measurement_source": F.lit("moves")},
                times={"start_time": c("Start"), "end_time": nb("End")}, loc=None)


def _summary(cols):
    c, nb, _, dist = _csv_parts(cols)
    dur = c("Duration")
    return dict(
        data_type="fitness", sub_type="daily_summary", ts=c("Date"),
        metrics={
            "steps": V.metric_when(nb("Steps").isNotNull(), V.int_prefix(c("Steps")), "steps", 0.9),
            "distance": dist,
            "calories": V.metric_when(nb("Calories").isNotNull(), V.float_prefix(c("Calories")),
                                      "calories", 0.7),
            "active_duration": V.metric_when(V.blank_to_null(dur).isNotNull(),
                                             V.float_prefix(dur) / 60, "minutes", 0.8),
        },
        attrs={"measurement_source": F.lit("moves")}, times={}, loc=None)


def _generic(cols, data_type):
    ts_f = V.first_matching_column(cols, ["date", "time", "start"])
    c = _csv_parts(cols)[0]
    return dict(data_type=data_type, sub_type="generic", ts=c(ts_f) if ts_f else F.lit(None),
                metrics={}, attrs={"measurement_source": F.lit("moves")}, times={}, loc=None,
                require=ts_f)


def _merge(branches: list[tuple[F.Column, dict]]):
    """Row-level routing between layouts: one projection, first match wins."""
    keys_m = {k for _, b in branches for k in b["metrics"]}
    keys_a = {k for _, b in branches for k in b["attrs"]}
    keys_t = {k for _, b in branches for k in b["times"]}

    def pick(get):
        out = None
        for cond, b in branches:
            v = get(b)
            if v is None:
                v = F.lit(None)
            out = F.when(cond, v) if out is None else out.when(cond, v)
        return out

    def lit(x):
        return x if isinstance(x, F.Column) else F.lit(x)

    return dict(
        data_type=pick(lambda b: lit(b["data_type"])),
        sub_type=pick(lambda b: lit(b["sub_type"])),
        ts=pick(lambda b: b["ts"]),
        metrics={k: pick(lambda b, k=k: b["metrics"].get(k)) for k in keys_m},
        attrs={k: pick(lambda b, k=k: b["attrs"].get(k)) for k in keys_a},
        times={k: pick(lambda b, k=k: b["times"].get(k)) for k in keys_t},
        loc=pick(lambda b: b["loc"] if b["loc"] is not None else V.null_location()),
    )


def normalize_csv(raw: DataFrame, kind: str) -> DataFrame:
    """One CSV layout group. ``kind`` = file base name (activities, places, ...)."""
    cols = header_cols(raw)
    df = with_raw_json(with_occurrence(raw), cols)

    def nb(name):
        return V.blank_to_null(V.col_or_null(cols, name))

    start, name, date = nb("Start"), nb("Name"), nb("Date")
    is_act = nb("Activity").isNotNull() & nb("Group").isNotNull()
    is_place = name.isNotNull() & nb("Latitude").isNotNull()
    keep = F.lit(True)
    if kind == "activities":
        branches = [(F.lit(True), _activity(cols))]
        keep = start.isNotNull() & nb("Activity").isNotNull()
    elif kind == "places":
        branches = [(F.lit(True), _place(cols))]
        keep = start.isNotNull() & name.isNotNull()
    elif kind == "storyline":
        branches = [(is_act, _activity(cols)), (is_place, _place(cols)),
                    (F.lit(True), _storyline_plain(cols))]
        keep = start.isNotNull() & (~is_act | nb("Activity").isNotNull())
    elif kind == "summary":
        branches = [(F.lit(True), _summary(cols))]
        keep = date.isNotNull()
    else:
        gen = _generic(cols, "mixed")
        branches = [(is_act, _activity(cols)), (is_place, _place(cols)), (F.lit(True), gen)]
        gen_ok = (V.blank_to_null(gen["ts"]).isNotNull() if gen["require"] else F.lit(False))
        keep = (F.when(is_act, start.isNotNull()).when(is_place, start.isNotNull())
                .otherwise(gen_ok))
    b = _merge(branches)
    return df.filter(keep).select(*pre_record(SOURCE, b["data_type"], b["sub_type"], b["ts"],
                                              b["metrics"], b["attrs"], b["times"], loc=b["loc"]))


# ---------------------------------------------------------------- JSON ------

def read_json(spark: SparkSession, paths: list[str], kind: str, multi_line: bool = True
              ) -> DataFrame:
    """Top-level JSON arrays -> one raw row per element (+ ``origin``).

    Arrays of a known kind are read by byte ranges, however large the file.
    ``multi_line=False`` reads JSON-lines files (one item per line).
    """
    schema = JSON_SCHEMAS.get(kind)
    if schema is not None and multi_line:
        return (json_arrays.elements(spark, paths).select(F.from_json("value", schema).alias("item"), "origin")
                .select("item.*", "origin"))
    reader = spark.read.option("multiLine", multi_line)
    reader = reader.schema(schema) if schema is not None else reader
    return reader.json(paths).withColumn("origin", F.col("_metadata.file_path"))


def _activity_json(item, raw):
    return dict(
        data_type="fitness", sub_type="activity", ts=item.getField("startTime"),
        metrics={
            "duration": V.metric_when(item.getField("duration").isNotNull()
                                      & (item.getField("duration") != 0),
                                      item.getField("duration") / 60, "minutes", 0.8),
            "distance": V.metric_when(item.getField("distance").isNotNull()
                                      & (item.getField("distance") != 0),
                                      item.getField("distance"), "meters", 0.8),
        },
        attrs={"activity_type": F.coalesce(V.blank_to_null(item.getField("activity")),
                                           F.lit("unknown")),
               "measurement_source": F.lit("moves")},
        times={"start_time": item.getField("startTime"),
               "end_time": V.blank_to_null(item.getField("endTime"))},
        raw=raw)


def _place_json(item, raw):
    place = item.getField("place")
    ll = place.getField("location")
    return dict(
        data_type="location", sub_type="location", ts=item.getField("startTime"),
        metrics={},
        attrs={"place_name": F.when(place.isNotNull(),
                                    F.coalesce(V.blank_to_null(place.getField("name")),
                                               F.lit("Unknown"))),
               "category": F.when(place.isNotNull(),
                                  F.coalesce(V.blank_to_null(place.getField("type")),
                                             F.lit("unknown"))),
               "measurement_source": F.lit("moves")},
        times={"arrival_time": item.getField("startTime"),
               "departure_time": V.blank_to_null(item.getField("endTime"))},
        loc=F.when(ll.isNotNull(), V.location(F.lit(None), ll.getField("lat"), ll.getField("lon"))),
        raw=raw)


def _emit(df, b):
    return df.select(*pre_record(SOURCE, b["data_type"], b["sub_type"], b["ts"], b["metrics"],
                                 b["attrs"], b["times"], loc=b.get("loc"), raw=b["raw"]))


def normalize_json(raw: DataFrame, kind: str) -> DataFrame:
    """Array elements of one JSON kind -> pre-records."""
    cols = header_cols(raw)
    df = with_occurrence(raw)
    item = F.struct(*[F.col(f"`{c}`") for c in cols])
    raw_json = F.to_json(item)
    if kind == "activities":
        return _emit(df.filter(V.blank_to_null(F.col("startTime")).isNotNull()),
                     _activity_json(item, raw_json))
    if kind == "places":
        return _emit(df.filter(V.blank_to_null(F.col("startTime")).isNotNull()),
                     _place_json(item, raw_json))
    if kind == "storyline":
        return normalize_storyline(df)
    ts_f = V.first_matching_column(cols, ["Time", "Date", "time"], lower=False)
    data_type = {"activities": "fitness", "places": "location",
                 "storyline": "location", "summary": "fitness"}.get(kind, "mixed")
    if ts_f is None:
        return _emit(df.limit(0), dict(data_type=data_type, sub_type="generic", ts=F.lit(None),
                                       metrics={}, attrs={}, times={}, raw=raw_json))
    df = df.filter(V.blank_to_null(F.col(f"`{ts_f}`").cast("string")).isNotNull())
    return _emit(df, dict(data_type=data_type, sub_type="generic",
                          ts=F.col(f"`{ts_f}`").cast("string"), metrics={},
                          attrs={"measurement_source": F.lit("moves")}, times={}, raw=raw_json))


def normalize_storyline(df: DataFrame) -> DataFrame:
    """Every place segment and every activity of every move segment.

    A record's raw text, which its id is made of, holds the whole item's hash
    and both positions, so items that share a segment keep records apart.
    """
    item = F.sha2(F.to_json("segments"), 256)
    segs = df.select("origin", "occurrence", item.alias("__item"),
                     F.posexplode(F.col("segments")).alias("__seg_pos", "__seg"))
    seg = F.col("__seg")
    at = [F.col("__item").alias("item"), F.col("__seg_pos").alias("segment")]
    places = segs.filter((seg.getField("type") == "place") & seg.getField("place").isNotNull()
                         & V.blank_to_null(seg.getField("startTime")).isNotNull())
    place_item = F.struct(seg.getField("startTime").alias("startTime"),
                          seg.getField("endTime").alias("endTime"),
                          seg.getField("place").alias("place"))
    p = _emit(places, _place_json(place_item, F.to_json(F.struct(*at, seg.alias("value")))))
    moves = segs.filter((seg.getField("type") == "move") & seg.getField("activities").isNotNull())
    acts = moves.select("origin", "occurrence", "__item", "__seg_pos",
                        F.posexplode(seg.getField("activities")).alias("__act_pos", "__act"))
    acts = acts.filter(V.blank_to_null(F.col("__act.startTime")).isNotNull())
    a = _emit(acts, _activity_json(F.col("__act"), F.to_json(F.struct(
        *at, F.col("__act_pos").alias("activity"), F.col("__act").alias("value")))))
    return union_all([p, a])
