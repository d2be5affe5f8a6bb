"""Driver tables: only small ones are dealt out, and lines reach their order as numbers."""

from __future__ import annotations

import datetime as dt

from vitaldf.plans import testdata as TD


def test_a_table_of_many_splits_is_read_without_a_shuffle(spark, tmpdir_path):
    for t in TD.TABLES:
        rows = spark.range(200_000 if t == "orders" else 10).withColumnRenamed("id", "k")
        rows.coalesce(1).write.parquet(f"{tmpdir_path}/{t}.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # orders is in one file of many splits
    try:
        TD.register_tables(spark, tmpdir_path)

        def dealt(t):
            return "Repartition" in spark.table(t)._jdf.queryExecution().optimizedPlan().toString()
        assert not dealt("orders") and dealt("events")
        assert spark.table("orders").count() == 200_000 and spark.table("events").count() == 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


LINES = [(1, dt.datetime(1996, 1, 2), 5.5, 10.0, 2), (1, dt.datetime(1996, 1, 1), 7.0, 10.9, 1),
         (1, None, 4.0, None, 1), (1, dt.datetime(1996, 1, 3), 9.0, 1.0, 3), (1, dt.datetime(1996, 1, 3), None, 1.0, 4),
         (1, dt.datetime(1996, 1, 3), 8.0, 1.0, None), (2, dt.datetime(1997, 5, 5), 50.0, 2.0, 6)]


def test_series_are_made_in_the_orders_task(spark):
    spark.createDataFrame(LINES, "l_orderkey bigint, l_shipdate timestamp, l_quantity double, "
                                 "l_extendedprice double, l_linenumber int").createOrReplaceTempView("lineitem")
    docs = TD.raw_minutes(spark)
    got = {r["origin"]: (r["metrics"][0]["values"], r["metricSummary"]["steps"]) for r in docs.collect()}
    # the line without a number comes first
    assert got == {"NikePlus-1996-01-01-act1-NoGPS.json": (["8", "4", "7", "5", "0", None], 335.0),
                   "NikePlus-1997-05-05-act2-NoGPS.json": (["0"], 500.0)}
    below = docs._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]
    assert "l_orderkey" in below and "collect_list" not in below
