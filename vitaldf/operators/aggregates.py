"""Statistics over records and tables (partial + final hash aggregation)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaldf.functions import date_render, m, metric_value
from vitaldf.operators.tables import RoutedTables


def agg_total(records: DataFrame) -> DataFrame:
    return records.agg(F.count(F.lit(1)).alias("total_records"))


def agg_by_source(records: DataFrame) -> DataFrame:
    return records.groupBy("source").agg(F.count(F.lit(1)).alias("record_count"))


def agg_by_type(records: DataFrame) -> DataFrame:
    return records.groupBy("data_type").agg(F.count(F.lit(1)).alias("record_count"))


def agg_group_by_type(records: DataFrame) -> DataFrame:
    return records.groupBy("source", "data_type").agg(F.count(F.lit(1)).alias("record_count"))


def agg_date_range(records: DataFrame) -> DataFrame:
    d = records.filter(F.col("date_only").isNotNull())
    return d.agg(F.min("date_only").alias("earliest"), F.max("date_only").alias("latest"))


def agg_table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, 0 for an empty one, in one job.

    Tables routed from the same records are counted in one pass over them.
    Of others, each adds a row of weight 0, so that none is missing.
    """
    if isinstance(tables, RoutedTables):
        counts = tables.records.agg(*[n.alias(name) for name, n in tables.row_counts().items()])
        return counts.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.col(name).alias("row_count")) for name in tables])))
    parts = [t.select(F.lit(name).alias("table_name"), F.lit(1).alias("n")) for name, t in tables.items()]
    spark = next(iter(tables.values())).sparkSession
    out = spark.createDataFrame([(name, 0) for name in tables], "table_name string, n int")
    for p in parts:
        out = out.unionByName(p)
    return out.groupBy("table_name").agg(F.sum("n").alias("row_count"))


def agg_processing_stats(finalized: DataFrame) -> DataFrame:
    """Per source: records, errors, success rate, distinct sub-types, date range.

    Grouped by source and sub-type first, then folded: a sub-type reaches a
    source's list once, however many rows have it.
    """
    ok = F.col("reason").isNull()
    by_type = finalized.groupBy("source", "sub_type").agg(
        F.count_if(ok).alias("ok"), F.count_if(~ok).alias("bad"),
        F.min(F.when(ok, F.col("timestamp"))).alias("first"), F.max(F.when(ok, F.col("timestamp"))).alias("last"))
    g = by_type.groupBy("source").agg(
        F.sum("ok").alias("total_records"), F.sum("bad").alias("total_errors"),
        F.array_sort(F.collect_list(F.when(F.col("ok") > 0, F.col("sub_type")))).alias("sub_types"),
        F.min("first").alias("earliest"), F.max("last").alias("latest"))
    total = F.col("total_records") + F.col("total_errors")
    return g.withColumn("success_rate",
                        F.when(total > 0, F.col("total_records") / total).otherwise(F.lit(0.0)))


def agg_totals_over_sources(stats: DataFrame) -> DataFrame:
    return stats.agg(F.sum("total_records").alias("processed"),
                     F.sum("total_errors").alias("errors"))


def agg_habit_stats(records: DataFrame) -> DataFrame:
    """Check-ins, distinct habits, longest / mean streak, date range."""
    h = records.filter(F.col("data_type") == "habits")
    streak = F.coalesce(metric_value(m("streak_days")), F.lit(0.0))
    return h.agg(
        F.count(F.lit(1)).alias("total_checkins"),
        F.count_distinct(F.col("attrs")["habit_name"]).alias("unique_habits"),
        F.max(streak).alias("longest_streak"),
        F.avg(streak).alias("average_streak"),
        F.min("date_only").alias("earliest"),
        F.max("date_only").alias("latest"),
    )


def agg_habit_categories(records: DataFrame) -> DataFrame:
    h = records.filter(F.col("data_type") == "habits")
    return h.groupBy(F.col("attrs")["habit_category"].alias("habit_category")).agg(
        F.count(F.lit(1)).alias("checkins"))


def agg_habit_frequency(records: DataFrame) -> DataFrame:
    h = records.filter(F.col("data_type") == "habits")
    return h.groupBy(F.col("attrs")["habit_name"].alias("habit_name")).agg(
        F.count(F.lit(1)).alias("checkins"))


def agg_migraine_summary(records: DataFrame) -> DataFrame:
    """Per severity: episodes, total and mean hours."""
    mg = records.filter(F.col("sub_type") == "migraine")
    hours = metric_value(m("duration"))
    return mg.groupBy(F.col("attrs")["severity"].alias("severity")).agg(
        F.count(F.lit(1)).alias("episodes"),
        F.sum(hours).alias("total_hours"),
        F.avg(hours).alias("mean_hours"))


def agg_activity_types(records: DataFrame) -> DataFrame:
    a = records.filter((F.col("source") == "moves") & (F.col("sub_type") == "activity"))
    return a.groupBy(F.col("attrs")["activity_type"].alias("activity_type")).agg(
        F.count(F.lit(1)).alias("record_count"))


def agg_place_categories(records: DataFrame) -> DataFrame:
    p = records.filter((F.col("source") == "moves") & (F.col("data_type") == "location")
                       & F.col("attrs")["category"].isNotNull())
    return p.groupBy(F.col("attrs")["category"].alias("category")).agg(
        F.count(F.lit(1)).alias("record_count"))


def agg_files_by_ext(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("ext").agg(F.count(F.lit(1)).alias("file_count"))


def agg_files_by_dir(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("dir").agg(F.count(F.lit(1)).alias("file_count"))


def agg_avg_file_size(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.round(F.avg("length") / 1024).cast("bigint").alias("avg_size_kb"))


def agg_largest_file(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.max_by("path", F.struct("length", "path")).alias("path"),
                         F.max("length").alias("length"))


def agg_record_span(records: DataFrame) -> DataFrame:
    """Earliest / latest date and the span in whole days (rounded)."""
    g = records.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    secs = F.unix_timestamp("hi") - F.unix_timestamp("lo")
    return g.select(date_render(F.col("lo")).alias("earliest"),
                    date_render(F.col("hi")).alias("latest"),
                    F.round(secs / 86400).cast("bigint").alias("span_days"))


def duplicate_ids(records: DataFrame) -> DataFrame:
    return (records.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))
