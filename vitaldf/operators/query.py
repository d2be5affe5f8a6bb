"""Record listing, filters, the date-range report and key checks."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _date(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (dt.date, dt.datetime)):
        return F.lit(x.strftime("%Y-%m-%d")).cast("date")
    return F.to_date(F.lit(x))


def filter_date_range(df: DataFrame, start=None, end=None, col: str = "date_only") -> DataFrame:
    """``col BETWEEN start AND end`` on a real DATE (applied when both are given)."""
    if start is None or end is None:
        return df
    return df.filter(F.col(col).between(_date(start), _date(end)))


def filter_source(df: DataFrame, source: str | None) -> DataFrame:
    return df if source is None else df.filter(F.col("source") == source)


def filter_type(df: DataFrame, data_type: str | None) -> DataFrame:
    return df if data_type is None else df.filter(F.col("data_type") == data_type)


def dynamic_predicate(start=None, end=None, source=None, data_type=None) -> Column:
    """AND of the predicates for the options that are set."""
    preds = [F.lit(True)]
    if start is not None and end is not None:
        preds.append(F.col("date_only").between(_date(start), _date(end)))
    if source is not None:
        preds.append(F.col("source") == source)
    if data_type is not None:
        preds.append(F.col("data_type") == data_type)
    return reduce(lambda a, b: a & b, preds)


def query_records(df: DataFrame, start=None, end=None, source=None, data_type=None,
                  limit: int | None = None) -> DataFrame:
    """Filtered records, newest first; with ``limit`` the first so many (TakeOrderedAndProject)."""
    out = df.filter(dynamic_predicate(start, end, source, data_type))
    out = out.orderBy(F.col("timestamp").desc(), F.col("id"))
    return out if limit is None else out.limit(limit)


REPORT_COLUMNS = {
    "fitness_metrics": ["steps", "calories", "distance", "workout_type"],
    "health_vitals": ["heart_rate", "systolic_bp", "diastolic_bp", "glucose"],
    "sleep_sessions": ["sleep_duration_minutes", "sleep_quality"],
    "habits": ["habit_name", "streak_days"],
    "symptoms": ["condition", "severity_score"],
}


def join_report(tables: dict[str, DataFrame], start=None, end=None,
                ordered: bool = True) -> DataFrame:
    """Parent records LEFT JOIN the five detail tables on the record id.

    The date filter is applied to the parent before the joins, and only the
    report columns of each detail table are read.  Catalyst picks the join
    strategy per side (broadcast when statistics prove a side small, else
    sort-merge); AQE re-plans with runtime sizes.
    """
    out = filter_date_range(tables["health_records"], start, end)
    # (callers that derive the tables from records can filter the records by
    # date first — see report_from_records — so every join input shrinks)
    for name, cols in REPORT_COLUMNS.items():
        child = tables[name].select(F.col("record_id").alias("id"), *cols)
        out = out.join(child, "id", "left")
    return out.orderBy("timestamp", "id") if ordered else out


def report_from_records(records: DataFrame, start=None, end=None, ordered: bool = True) -> DataFrame:
    """The report built from health records: the date filter is applied to
    the records before they are routed into the tables, so the detail sides
    of the joins only hold in-range rows (same result, smaller joins)."""
    from vitaldf.operators.tables import route_records
    return join_report(route_records(filter_date_range(records, start, end)), start, end, ordered)


def sort_report(df: DataFrame) -> DataFrame:
    return df.orderBy("timestamp", "id")


def exists_record(candidates: DataFrame, records: DataFrame, key: str = "id") -> DataFrame:
    """Candidate ids that exist in the records (batch form of a key lookup)."""
    return candidates.join(records.select(key), key, "left_semi")


def exists_any(records: DataFrame) -> bool:
    return not records.isEmpty()


#: combinations of values that go into a filter, at most
MAX_VALUES = 1 << 13


def early_rows(df: DataFrame, group_cols, order_col: str, n: int, read_cols) -> DataFrame:
    """``df`` without rows that can't be among a group's first ``n``, told by ``read_cols`` alone.

    The rows with a group's ``n`` smallest values of ``order_col`` are found
    first, and a filter takes the values that they have in ``read_cols``.  It
    also leaves others, but where those columns are made of input columns it
    is pushed down to the input, below what makes the other columns.  ``df``
    stays whole if there are more than MAX_VALUES combinations of such values.
    """
    from pyspark.sql import Window
    place = F.dense_rank().over(Window.partitionBy(*group_cols).orderBy(order_col))
    ahead = df.select(*group_cols, order_col, *read_cols).withColumn("__rn", place).filter(F.col("__rn") <= n)
    found = ahead.select(*read_cols).distinct().limit(MAX_VALUES + 1).collect()
    if len(found) > MAX_VALUES:
        return df
    for c in read_cols:
        has = F.col(c).isin(sorted({r[c] for r in found} - {None}))
        df = df.filter(has | F.col(c).isNull() if any(r[c] is None for r in found) else has)
    return df


def sample_first_n(df: DataFrame, group_cols, order_cols, n: int = 5, salts: int = 64,
                   read_cols=()) -> DataFrame:
    """First ``n`` rows per group in the given order (a sampling operator).

    Two phases so that no task ever sorts a whole (possibly huge) group:
    the top ``n`` of each of ``salts`` hash sub-groups first, then the top
    ``n`` of those at most ``salts * n`` candidates per group.  With
    ``read_cols``, rows that come too late are left out before
    (:func:`early_rows`).
    """
    from pyspark.sql import Window
    if read_cols:
        df = early_rows(df, group_cols, order_cols[0], n, read_cols)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in order_cols]), F.lit(salts))
    w1 = Window.partitionBy(*group_cols, "__salt").orderBy(*order_cols)
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    first = (df.withColumn("__salt", salt).withColumn("__rn", F.row_number().over(w1))
             .filter(F.col("__rn") <= n).drop("__rn", "__salt"))
    return first.withColumn("__rn", F.row_number().over(w2)).filter(F.col("__rn") <= n).drop("__rn")


def orphans(child: DataFrame, parent: DataFrame) -> DataFrame:
    """Detail rows whose record id has no parent (FK integrity)."""
    return child.join(parent.select(F.col("id").alias("record_id")), "record_id", "left_anti")
