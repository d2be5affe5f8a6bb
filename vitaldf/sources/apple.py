"""Phone-health XML export (`<Record .../>`, `<Workout .../>` elements).

Multi-GB exports are read as text cut at every ``<``, which Spark splits
across tasks.  That character stands for nothing but the start of a tag in
well-formed XML, so each opening tag is one row, whether elements share a
line or a tag spans several.  Its attributes become a map with
`regexp_extract_all`; a tag without an end or with a repeated attribute is
kept as a reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaldf import functions as V
from vitaldf.operators.records import pre_record, with_occurrence
from vitaldf.schema import APPLE_METRIC_KEYS

SOURCE = "apple_health"
SLEEP_TYPE = "HKCategoryTypeIdentifierSleepAnalysis"


def read(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Opening tags of the export: (origin, tag, line)."""
    return _tags(spark.read.option("lineSep", "<").text(paths)
                 .select(F.col("_metadata.file_path").alias("origin"), F.col("value").alias("piece")))


def lines_to_elements(lines: DataFrame) -> DataFrame:
    """Text (value, origin) holding whole tags -> (origin, tag, line) for Record/Workout tags."""
    return _tags(lines.select("origin", F.explode(F.split("value", "<")).alias("piece")))


def _tags(pieces: DataFrame) -> DataFrame:
    tag = F.regexp_extract("piece", r"^(Record|Workout)(?:[\s/>]|$)", 1)
    # attribute values may hold '>' but no tag ends inside one
    opening = F.regexp_extract("piece", r'^[^">]*+(?:"[^"]*+"[^">]*+)*+>', 0)
    line = F.concat(F.lit("<"), F.when(opening != "", opening).otherwise(F.rtrim("piece")))
    return (pieces.withColumn("tag", tag).filter(F.col("tag") != "")
            .select("origin", "tag", line.alias("line")))


def read_xml(spark: SparkSession, paths: list[str], row_tag: str) -> DataFrame:
    """Element rows via the XML reader, as attribute maps."""
    df = (spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "")
          .load(paths).withColumn("origin", F.col("_metadata.file_path")))
    attr_cols = [c for c in df.columns if c not in ("origin",) and not c.startswith("_")]
    kv = []
    for c in attr_cols:
        kv += [F.lit(c), F.col(f"`{c}`").cast("string")]
    return df.select("origin", F.lit(row_tag).alias("tag"),
                     F.map_filter(F.create_map(*kv), lambda k, v: v.isNotNull()).alias("attrs"))


def sample(elements: DataFrame, every: int = 10) -> DataFrame:
    """Opt-in deterministic 1-in-``every`` sample of the elements."""
    h = F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("bigint")
    return elements.filter(h % every == 0)


def with_attributes(elements: DataFrame) -> DataFrame:
    """Parse each element's attributes once; NULL for a malformed tag.

    The barrier keeps filters on attributes above this projection instead
    of pushing them below with the regex copied into every predicate.
    """
    if "attrs" in elements.columns:
        return elements
    parsed = F.when(F.col("line").endswith(">"), V.xml_attributes(F.col("line")))
    return elements.withColumn("attrs", V.barrier(parsed))


def normalize(elements: DataFrame) -> DataFrame:
    """Elements (origin, tag, line | attrs) -> pre-records, in one projection.

    Records of mapped types, workouts, and malformed tags (as rejects).
    """
    df = with_attributes(with_occurrence(elements))
    dtype = F.when(_a("type").isNotNull(), V.datatype_apple(_a("type"))).otherwise(F.lit("unknown"))
    df = df.withColumns({"__start": _a("startDate"), "__end": _a("endDate"),
                         "__bad": F.col("attrs").isNull(), "__dtype": dtype})
    bad, workout = F.col("__bad"), F.col("tag") == "Workout"
    rec, wk = record_fields(), workout_fields()

    def both(kind):
        return {k: F.when(bad, None).when(workout, wk[kind].get(k, F.lit(None))).otherwise(
            rec[kind].get(k, F.lit(None))) for k in {**rec[kind], **wk[kind]}}

    raw = F.to_json(F.col("attrs"))
    if "line" in df.columns:
        raw = F.when(bad, F.col("line")).otherwise(raw)
    return (df.filter(bad | workout | (F.col("__dtype") != "unknown"))
            .select(*pre_record(
                SOURCE, F.when(bad, "unknown").when(workout, "fitness").otherwise(F.col("__dtype")),
                F.when(bad, F.lower("tag")).when(workout, "workout").otherwise(V.subtype_apple(_a("type"))),
                F.when(workout, F.col("__start")).otherwise(
                    F.coalesce(V.blank_to_null(F.col("__start")), _a("creationDate"))),
                metrics=both("metrics"), attrs=both("attrs"), times=both("times"), raw=raw,
                problem=F.when(bad, F.lit("Malformed element")))))


def _a(name):
    return F.col("attrs").getItem(name)


def typed(df: DataFrame) -> DataFrame:
    """Record elements with their mapped data type ('unknown' when unmapped)."""
    return (df.filter((F.col("tag") == "Record") & _a("type").isNotNull())
            .withColumn("__dtype", V.datatype_apple(_a("type"))))


def record_fields() -> dict[str, dict]:
    rtype = _a("type")
    start, end = _a("startDate"), _a("endDate")
    is_sleep = rtype == SLEEP_TYPE
    value = V.float_prefix(_a("value"))
    unit = V.unit_map_apple(_a("unit"))
    conf = V.confidence_source(_a("sourceName"))
    has_value = _a("value").isNotNull() & ~is_sleep
    key = V.lookup(APPLE_METRIC_KEYS, rtype, "metric_value")
    ranged = end.isNotNull() & (end != F.coalesce(start, F.lit("")))
    minutes = V.duration_minutes("__start", "__end")
    metrics = {k: V.metric_when(has_value & (key == k), value, unit, conf)
               for k in sorted(set(APPLE_METRIC_KEYS.values()) | {"metric_value"})}
    metrics["duration"] = V.metric_when(ranged & ~is_sleep, minutes, "minutes", 0.9)
    metrics["sleep_duration"] = V.metric_when(ranged & is_sleep, minutes, "minutes", 0.9)
    return {"metrics": metrics,
            "attrs": {"device_name": F.coalesce(_a("sourceName"), F.lit("Unknown")),
                      "source_version": _a("sourceVersion"),
                      "sleep_stage": F.when(is_sleep, _a("value"))},
            "times": {"end_time": F.when(ranged & ~is_sleep, end),
                      "sleep_start": F.when(is_sleep, start),
                      "sleep_end": F.when(is_sleep, end)}}


def workout_fields() -> dict[str, dict]:
    start, end = _a("startDate"), _a("endDate")
    dur = V.blank_to_null(_a("duration"))
    energy = V.blank_to_null(_a("totalEnergyBurned"))
    dist = V.blank_to_null(_a("totalDistance"))
    computed = start.isNotNull() & end.isNotNull()
    return {
        "metrics": {
            "duration": F.when(dur.isNotNull(),
                               V.metric(V.float_prefix(dur),
                                        F.coalesce(V.blank_to_null(_a("durationUnit")),
                                                   F.lit("minutes")), 0.9))
                         .when(computed, V.metric(V.duration_minutes("__start", "__end"),
                                                  "minutes", 0.9)),
            "calories": V.metric_when(energy.isNotNull(), V.float_prefix(energy),
                                      F.coalesce(V.blank_to_null(_a("totalEnergyBurnedUnit")),
                                                 F.lit("calories")), 0.8),
            "distance": V.metric_when(dist.isNotNull(), V.float_prefix(dist),
                                      F.coalesce(V.blank_to_null(_a("totalDistanceUnit")),
                                                 F.lit("miles")), 0.8),
        },
        "attrs": {"workout_type": F.coalesce(_a("workoutActivityType"), F.lit("Unknown"))},
        "times": {"start_time": start, "end_time": end}}


def type_distribution(elements: DataFrame) -> DataFrame:
    """Record elements per mapped data type, 'unknown' included."""
    return (typed(with_attributes(elements)).groupBy(F.col("__dtype").alias("data_type"))
            .agg(F.count(F.lit(1)).alias("record_count")))
