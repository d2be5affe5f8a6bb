"""Queries over all records that read them in few passes, and do their whole job."""

import datetime as dt
import os

from pyspark.sql import functions as F

from vitaldf import functions as V
from vitaldf.operators import aggregates as AG
from vitaldf.operators import quality as DQ
from vitaldf.operators import query as QY
from vitaldf.operators import store as ST
from vitaldf.operators import tables as TB
from vitaldf.operators.records import of_days
from vitaldf.plans import exports, q_files, q_tables, registry
from vitaldf.schema import RECORD

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _record(i, data_type, attrs=None, metrics=None, symptoms=None, source="x"):
    now = dt.datetime(2020, 1, 1 + i % 20, 10)
    return (str(i), now, now.date(), source, data_type, "t", now, metrics or {}, attrs or {}, {}, symptoms, None,
            "{}", f"f{i % 2}")


def _records(spark):
    pain = {"pain_intensity": (3.0, "units", 0.9)}
    return spark.createDataFrame([
        _record(1, "fitness"), _record(2, "fitness", source="y"), _record(2, "fitness"), _record(3, "health"),
        _record(4, "health", {"condition": "migraine"}), _record(5, "health", {"severity": "low"}, source=None),
        _record(6, "sleep", symptoms=["nausea"]), _record(7, None, {"medication_name": "m", "condition": None}),
        _record(8, "location", {"pain_location": "knee"}, pain), _record(9, "mixed", metrics=pain),
        _record(10, "health", {"medication_name": "n"}, source="y")], RECORD)


def test_routed_tables_are_counted_in_one_pass(spark):  # F4, F15
    tables = TB.route_records(_records(spark))
    counts = AG.agg_table_counts(tables)
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {n: t.count() for n, t in tables.items()}
    plain = AG.agg_table_counts(dict(tables.items()))
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, plain.collect()))
    assert counts.dtypes == plain.dtypes
    assert _plan(counts).count("LogicalRDD") == 1
    none = AG.agg_table_counts(TB.route_records(_records(spark).filter("id = 'no'")))
    assert {r["row_count"] for r in none.collect()} == {0} and none.count() == len(TB.MAPPERS)
    registry.prepare(spark, SF)
    plan = _plan(q_tables.agg_table_counts(spark))
    assert plan.count("habits") and plan.count("Union") == _plan(q_tables.agg_total(spark)).count("Union")


def test_deleted_rows_of_routed_tables_are_counted_in_one_pass(spark):  # F12
    records = _records(spark)
    for source in ("x", "y", "none"):
        tables = TB.route_records(records, ["source"])
        rest, left, counts = ST.delete_by_source(records, tables, source)
        rest2, left2, counts2 = ST.delete_by_source(records, dict(tables.items()), source)
        assert counts.collect() == counts2.collect() and counts.dtypes == counts2.dtypes
        assert sorted(left) == sorted(left2)
        for name in left2:
            assert sorted(map(str, left[name].collect())) == sorted(map(str, left2[name].collect()))
        assert rest.count() == rest2.count()
    assert _plan(counts).count("LogicalRDD") == 1


def test_expected_fields_of_every_record_are_checked(spark):  # F14, F17
    registry.prepare(spark, SF)
    whole = registry.recs(spark).groupBy("sub_type").count().collect()
    seen = q_files.dq_expected_fields(spark).groupBy("sub_type").agg(F.sum("records").alias("count")).collect()
    assert sorted(map(tuple, seen), key=str) == sorted(map(tuple, whole), key=str)


def test_missing_fields_are_told_by_the_keys_of_the_maps(spark):  # F14
    odd = _records(spark).select("data_type", "metrics", "attrs", "times").limit(0)
    m = (1.0, "u", 1.0)
    rows = [("health", {"bp_diastolic": m}, {}, {}), ("health", {}, {"blood_pressure": "x"}, {}),
            ("health", {"heart_rate": None}, {}, {}), ("fitness", {"calories": m}, {"steps": "1"}, {}),
            ("sleep", {}, {}, {"sleep_end": None}), ("mixed", {}, {}, {}), (None, {}, {}, {}), ("", {}, {}, {}),
            ("health", None, {}, {})]
    got = DQ.dq_expected_fields(spark.createDataFrame(rows, odd.schema)).select("missing_schema").collect()
    assert [r[0] for r in got] == [
        ["heart_rate"], ["heart_rate"], ["blood_pressure"], ["distance"], ["sleep_duration", "sleep_start"], [], [],
        [], None]


def test_summary_tells_what_the_damage_does_to_each_check(spark):  # F18
    registry.prepare(spark, SF)
    got = {r["source"]: r.asDict() for r in q_files.dq_summary(spark).collect()}
    whole = {r["source"]: r["n"] for r in DQ.dq_expected_fields(registry.recs(spark)).groupBy("source").agg(
        F.count_if(F.size("missing_schema") > 0).alias("n")).collect()}
    assert got["apple_health"]["schema_violations"] == whole["apple_health"] > 0  # none of it is damaged
    # a damaged record loses its type, and with it what is expected of it
    assert 0 < got["gyroscope"]["schema_violations"] < whole["gyroscope"]


def test_days_are_told_by_texts_before_copies_are_numbered(spark):  # F3, F5
    day, late = dt.date(1995, 6, 1), dt.date(1995, 12, 31)
    texts = ["1995-06-01 00:00:00", "1995-12-31-23:59:59", "12/31/1995 01:02:03", "06/01/1995", "1995-07",
             "1996-01-01 03:04:05 +0800", "1996-1-1T01:00:00+05:00", "1995-05-31 20:00:00 -0800", "001995-08-01",
             "Sat Jul 01 10:00:00 1995", "1996-01-02 00:00:00", "1994-12-31", "2020-01-01", "", None, "x"]
    now = dt.datetime.now(dt.timezone.utc).date()
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("d", F.to_date(V.ts_parse("t")))
    told = df.withColumn("told", V.may_be_of_days("t", day, late))
    assert told.filter(F.col("d").between(F.lit(day), F.lit(late)) & ~F.col("told")).count() == 0
    assert {r["t"] for r in told.filter("told").collect()} == set(texts[:10])
    clock = spark.createDataFrame([("12:30",), ("T1:02:03",), (" 01:02",)], "t string")
    assert clock.filter(V.may_be_of_days("t", now, now)).count() == 3
    new_year = spark.createDataFrame([("1994-12-31 20:00:00 -0800",), ("1994-12-30",)], "t string")
    assert new_year.filter(V.may_be_of_days("t", dt.date(1995, 1, 1), late)).count() == 1
    registry.prepare(spark, SF)
    made = registry.fin(spark, "sleep_simple", "gyro_all", "habits")
    plan = _plan(of_days(made, day, late).select("id"))
    parts = plan.split("Window")[1:]
    assert len(parts) == 3 and all("1995" in p for p in parts)
    whole = made.filter(F.col("date_only").between(F.lit(day), F.lit(late))).select("id", "timestamp")
    assert sorted(map(str, of_days(made, day, late).select("id", "timestamp").collect())) == sorted(
        map(str, whole.collect()))


def test_report_makes_the_records_of_its_range_once(spark):  # F3, F5
    registry.prepare(spark, SF)
    plan = _plan(q_tables.join_report(spark))
    assert "Window" not in plan and "Generate" not in plan and plan.count("Join LeftOuter") == 5


def test_orphans_of_all_tables_are_found_by_one_join(spark):  # F6
    records = _records(spark)
    tables = TB.route_records(records)
    parent = tables["health_records"].filter("id not in ('2', '4', '8')")
    lone = QY.orphans(tables.detail_ids(), parent).select(F.explode("tables").alias("t")).groupBy("t").count()
    each = {n: QY.orphans(tables[n], parent).count() for n in tables.details()}
    assert {r["t"]: r["count"] for r in lone.collect()} == {n: k for n, k in each.items() if k}
    registry.prepare(spark, SF)
    assert _plan(q_tables.join_parent_child(spark)).count("Join LeftAnti") == 1


def test_replayed_rejects_are_made_once(spark, monkeypatch):  # F16
    registry.prepare(spark, SF)
    plans, sink = [], ST.Store.replace_rejects
    monkeypatch.setattr(ST.Store, "replace_rejects", lambda self, df, *a: (plans.append(_plan(df)), sink(self, df, *a)))
    rows = q_files.sink_rejects(spark).collect()
    assert len(plans) == 2 and not any("Generate" in p or "Union" in p for p in plans)
    assert sum(r["rejects"] for r in rows) == registry.fin(spark).filter("reason is not null").count() > 0


def test_small_files_are_there_a_batch_at_a_time(spark, tmpdir_path):  # F8
    rows = spark.createDataFrame([(f"d{i}", f"text {i}") for i in range(45)], "name string, value string")
    folders = []

    def scan(folder):
        folders.append((folder, len(os.listdir(folder))))
        return spark.read.text(folder).select("value", F.col("_metadata.file_name").alias("name"))
    out = exports.scan_each(spark, rows, f"{tmpdir_path}/each", scan, at_once=16)
    assert sorted((r["name"], r["value"]) for r in out.collect()) == sorted(map(tuple, rows.collect()))
    assert sum(n for _, n in folders) == 45 and max(n for _, n in folders) <= 16
    assert not any(os.path.exists(f) for f, _ in folders)
    none = exports.scan_each(spark, rows.limit(0), f"{tmpdir_path}/none", lambda f: spark.read.schema("a int").json(f))
    assert none.count() == 0
