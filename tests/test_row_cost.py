"""What a row costs: compiled methods, one look at the file name, no failing casts."""

from pyspark.sql import functions as F

from vitaldf import functions as V
from vitaldf.operators.records import finalize
from vitaldf.plans import registry
from vitaldf.schema import GYRO_FILE_PATTERN
from vitaldf.sources import gyroscope


def test_generated_methods_are_small_enough_to_be_compiled(spark):  # F28, F27, F25, F6
    registry.prepare(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_the_sub_type_is_found_once_a_row(spark):  # F28, F25
    raw = spark.createDataFrame([("/a/b/gyroscope-u-steps-export.csv", "2020-01-01", "5")],
                                "origin string, date string, steps string")
    fin = finalize(gyroscope.normalize(raw))
    plan = fin._jdf.queryExecution().optimizedPlan().toString()
    # asked twice of it: is there a type, and which
    assert plan.count(GYRO_FILE_PATTERN) == 2
    r = fin.first()
    assert (r["sub_type"], r["data_type"], r["metrics"]["steps"]["value"]) == ("steps", "fitness", 5.0)


def test_file_names(spark):
    paths = ["a/b/c.csv", "c.csv", "a/", "", None, "file:///x/y z.csv", "a/b\n", "/"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    got = [r["n"] for r in df.select("i", V.file_name("p").alias("n")).orderBy("i").collect()]
    assert got == [None if p is None else p.rsplit("/", 1)[-1] for p in paths]


def test_number_prefixes(spark):
    texts = ["", " ", None, "x", "12 steps", " +7", "-3.5e2x", ".5", "+.5e", ".", "-", "1.", "99999999999999999999"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    r = df.select("i", V.int_prefix(F.col("t")).alias("n"), V.float_prefix(F.col("t")).alias("x")).orderBy("i").collect()
    assert [x["n"] for x in r] == [None, None, None, None, 12.0, 7.0, -3.0, None, None, None, None, 1.0, None]
    assert [x["x"] for x in r] == [None, None, None, None, 12.0, 7.0, -350.0, 0.5, 0.5, None, None, 1.0, 1e20]
