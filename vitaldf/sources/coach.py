"""Habit-tracker CSV export (Id, Habit, Date, Note, Check In Count, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaldf import functions as V
from vitaldf.operators.records import header_cols, pre_record, with_occurrence, with_raw_json

SOURCE = "coach_me"
COLUMNS = ["Id", "Habit", "Date", "Note", "Check In Count", "Days in Streak",
           "Prop Count", "Comment Count", "URL"]


def normalize(raw: DataFrame) -> DataFrame:
    cols = header_cols(raw)
    df = with_raw_json(with_occurrence(raw), cols)

    def c(name):
        return V.col_or_null(cols, name)

    def nb(name):
        return V.blank_to_null(c(name))

    # A row without Date or Habit is not a check-in: it yields no record.
    df = df.filter(nb("Date").isNotNull() & nb("Habit").isNotNull())
    habit = F.trim(c("Habit"))
    metrics = {
        "checkin_count": V.metric(V.or_default(V.int_prefix(c("Check In Count")), 1),
                                  "checkins", 1.0),
        "streak_days": V.metric(V.or_default(V.int_prefix(c("Days in Streak")), 0), "days", 1.0),
        # the text "0" counts as present (only the empty text is missing)
        "prop_count": V.metric_when(c("Prop Count") != "", V.int_prefix(c("Prop Count")),
                                    "props", 1.0),
        "comment_count": V.metric_when(c("Comment Count") != "",
                                       V.int_prefix(c("Comment Count")), "comments", 1.0),
        "completion_confidence": V.metric(1.0, "confidence", 1.0),
    }
    attrs = {
        "habit_id": c("Id"),
        "habit_name": habit,
        "habit_category": V.habit_categorize(habit),
        "notes": F.coalesce(nb("Note"), F.lit("")),
        "coach_me_url": c("URL"),
        "completed": F.lit("true"),
    }
    times = {"checkin_date": c("Date")}
    return df.select(*pre_record(SOURCE, "habits", "habit_checkin", c("Date"),
                                 metrics, attrs, times))
