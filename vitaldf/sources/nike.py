"""Wristband JSON documents: one summary record + one record per non-zero minute.

Documents are read with an explicit schema (`multiLine`), the date comes
from the file name, and the minute series are flattened with
`explode` + `posexplode` — never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaldf import functions as V
from vitaldf.operators.records import pre_record, union_all, with_occurrence
from vitaldf.schema import NIKE_DEFAULTS, NIKE_FILE_PATTERN

SOURCE = "nike_plus"

DOC_SCHEMA = T.StructType([
    T.StructField("activityId", T.StringType()),
    T.StructField("activityTimeZone", T.StringType()),
    T.StructField("activityType", T.StringType()),
    T.StructField("deviceType", T.StringType()),
    T.StructField("metricSummary", T.StructType([
        T.StructField("calories", T.DoubleType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("duration", T.StringType()),
        T.StructField("fuel", T.DoubleType()),
        T.StructField("steps", T.DoubleType()),
    ])),
    T.StructField("metrics", T.ArrayType(T.StructType([
        T.StructField("metricType", T.StringType()),
        T.StructField("intervalMetric", T.LongType()),
        T.StructField("values", T.ArrayType(T.StringType())),
    ]))),
])
DOC_COLS = DOC_SCHEMA.fieldNames()


def skip_file(name) -> F.Column:
    """Log / diagnostic / readme files carry no activity data."""
    return name.endswith(".log") | name.contains("diagnostic") | name.contains("readme")


def read(spark: SparkSession, paths: list[str]) -> DataFrame:
    """JSON documents -> one raw row per file (+ ``origin``)."""
    df = (spark.read.schema(DOC_SCHEMA).option("multiLine", True).json(paths)
          .withColumn("origin", F.col("_metadata.file_path")))
    return df.filter(~skip_file(V.file_name(F.col("origin"))))


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """JSON-lines bundles: one document per line; a line may carry the name
    of the file it was exported as in ``origin`` (else the bundle path)."""
    schema = T.StructType(DOC_SCHEMA.fields + [T.StructField("origin", T.StringType())])
    df = spark.read.schema(schema).json(paths)
    return df.withColumn("origin", F.coalesce(F.col("origin"), F.col("_metadata.file_path")))


def _truthy(x) -> F.Column:
    return x.isNotNull() & (x != 0)


def normalize(raw: DataFrame) -> DataFrame:
    """Raw documents (DOC_SCHEMA columns + ``origin``) -> pre-records."""
    df = with_occurrence(raw)
    fname = V.file_name(F.col("origin"))
    date_str = F.regexp_extract(fname, NIKE_FILE_PATTERN, 1)
    df = df.withColumns({
        "__date": F.when(date_str != "", date_str),
        "__act": F.coalesce(F.col("activityId"),
                            F.when(F.regexp_extract(fname, NIKE_FILE_PATTERN, 2) != "",
                                   F.regexp_extract(fname, NIKE_FILE_PATTERN, 2))),
        "__base": F.concat(date_str, F.lit(" 00:00:00")),
        "raw_data": F.to_json(F.struct(*[F.col(c) for c in DOC_COLS])),
    })
    # a file whose name carries no date yields no record: route it to rejects
    # through an empty timestamp
    base_ts = F.when(F.col("__date").isNotNull(), F.col("__base"))

    s = F.col("metricSummary")
    dur = V.duration_hms_minutes(s.getField("duration"))
    summary = df.select(*pre_record(
        SOURCE, "fitness", "activity", base_ts,
        metrics={
            "steps": V.metric_when(_truthy(s.getField("steps")), s.getField("steps"), "steps", 0.9),
            "calories": V.metric_when(_truthy(s.getField("calories")), s.getField("calories"),
                                      "calories", 0.8),
            "distance": V.metric_when(_truthy(s.getField("distance")), s.getField("distance"),
                                      "miles", 0.7),
            "fuel_points": V.metric_when(_truthy(s.getField("fuel")), s.getField("fuel"),
                                         "fuel", 1.0),
            "duration": V.metric_when(V.blank_to_null(s.getField("duration")).isNotNull()
                                      & (dur > 0), dur, "minutes", 0.9),
        },
        attrs={
            "activity_id": F.col("__act"),
            "activity_type": F.coalesce(V.blank_to_null(F.col("activityType")),
                                        F.lit(NIKE_DEFAULTS["activity_type"])),
            "device_type": F.coalesce(V.blank_to_null(F.col("deviceType")),
                                      F.lit(NIKE_DEFAULTS["device_type"])),
            "timezone": F.coalesce(V.blank_to_null(F.col("activityTimeZone")),
                                   F.lit(NIKE_DEFAULTS["timezone"])),
        }))
    return union_all([summary, minute_records(df)])


def explode_minutes(df: DataFrame) -> DataFrame:
    """One row per (series, position) value that is not zero."""
    series = df.filter(F.col("__date").isNotNull()).select(
        "*", F.posexplode(F.col("metrics")).alias("__series", "__m"))
    vals = series.filter(F.col("__m.values").isNotNull()).select(
        "*", F.posexplode(F.col("__m.values")).alias("__pos", "__val"))
    interval = V.or_default(F.col("__m.intervalMetric").cast("double"), 1).cast("bigint")
    return (vals.filter(F.col("__val").isNull() | (F.trim(F.col("__val")) != "0"))
            .withColumns({"__interval": interval,
                          "__offset": F.col("__pos") * interval,
                          "__type": F.lower(F.col("__m.metricType"))}))


def minute_records(df: DataFrame) -> DataFrame:
    v = explode_minutes(df)
    t = F.col("__type")
    ts = V.ts_render(V.ts_add_minutes(V.ts_parse("__base"), F.col("__offset")))
    ival = V.int_prefix(F.col("__val"))
    return v.select(*pre_record(
        SOURCE, "fitness", F.concat(F.lit("minute_"), F.coalesce(t, F.lit("undefined"))), ts,
        metrics={
            "fuel_points": V.metric_when(t == "fuel", ival, "fuel", 0.9),
            "steps": V.metric_when(t == "steps", ival, "steps", 0.9),
            "calories": V.metric_when(t == "calories", ival, "calories", 0.8),
            "metric_value": V.metric_when(~t.isin("fuel", "steps", "calories") | t.isNull(),
                                          V.float_prefix(F.col("__val")), t, 0.7),
        },
        attrs={"activity_id": F.col("__act"),
               "minute_offset": F.col("__offset"),
               "interval_minutes": F.col("__interval")},
        raw=F.to_json(F.struct(F.col("__val").alias("originalValue"),
                               F.col("__m.metricType").alias("metricType"),
                               F.col("__series").alias("series"),
                               F.col("__pos").alias("index")))))
