"""Queries over all records that need not number copies, join ids or shuffle whole rows."""

from pyspark.sql import functions as F

from vitaldf.operators import query as QY
from vitaldf.operators import store as ST
from vitaldf.plans import q_files, q_functions, registry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_metric_columns_come_with_their_sub_type(spark):  # F30
    registry.prepare(spark, SF)
    assert "Join" not in _plan(q_functions.metric_value_unit_confidence(spark))


def test_required_fields_of_all_records_number_no_copies(spark):  # F13, F15
    registry.prepare(spark, SF)
    plan = _plan(q_files.dq_summary(spark))
    assert "Window" not in plan and "sha2" in plan  # ids are still made and looked at
    assert "Window" not in _plan(q_files.dq_score_records(spark))


def test_delete_by_source_tells_rows_by_their_source(spark):  # F12
    records = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "id string, source string")
    own = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("c", None)],
                                "record_id string, source string")
    rest, tables, counts = ST.delete_by_source(records, {"own": own, "bare": own.drop("source")}, "x")
    assert "Join" not in _plan(tables["own"])
    assert counts.first().asDict() == {"deleted_records": 1, "deleted_related": 4}
    for t in tables.values():
        assert sorted(r[0] for r in t.collect()) == ["b", "c"]


def test_early_rows_leave_the_sample_as_it_was(spark):  # F3
    rows = [(g, t, f"{g}{t}{i}" if t else None, i) for g in ("p", None) for t in (1, 1, 2, 3, None)
            for i in range(3)]
    df = spark.createDataFrame(rows, "g string, t int, text string, id int")
    whole = QY.sample_first_n(df, ["g"], ["t", "id"], 4)
    early = QY.sample_first_n(df, ["g"], ["t", "id"], 4, read_cols=["text"])

    def seen(d):
        return sorted(map(str, d.select("g", "t", "id").collect()))
    assert seen(early) == seen(whole)
    cut = QY.early_rows(df, ["g"], "t", 2, ["text"])
    assert sorted({r["t"] for r in cut.filter(F.col("t").isNotNull()).collect()}) == [1]
