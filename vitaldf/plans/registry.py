"""Query registry shared by the catalog modules, and the record builders they use."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaldf.operators.records import finalize, valid
from vitaldf.plans import testdata as TD
from vitaldf.session import apply_session_conf, shared_dir
from vitaldf.sources import apple, coach, gyroscope, manual, moves, nike, sleep

# name -> (spark builder taking the session, oracle SQL builder or None)
CATALOG: dict[str, tuple[Callable[[SparkSession], DataFrame], Callable[[], str] | None]] = {}


def q(name: str, sql: Callable[[], str] | None = None):
    def deco(fn):
        assert name not in CATALOG, name
        CATALOG[name] = (fn, sql)
        return fn
    return deco


_STATE: dict = {"sf_dir": None}
_PLANS: dict = {}


def prepare(spark: SparkSession, sf_dir: str) -> None:
    apply_session_conf(spark)
    TD.register_tables(spark, sf_dir)
    _STATE["sf_dir"] = sf_dir


def _memo(kind: str, spark: SparkSession, names: tuple, build):
    """Built plans are immutable: reuse them within a session and data folder."""
    key = (kind, spark.sparkContext.applicationId, _STATE["sf_dir"], names)
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


# ------------------------------------------------------------ record sets ---

LAYOUTS: dict[str, Callable[[SparkSession], DataFrame]] = {
    "gyro_steps": lambda s: gyroscope.normalize(TD.raw_steps(s)),
    "gyro_vitals": lambda s: gyroscope.normalize(gyroscope.union_raw(list(TD.raw_vitals(s).values()))),
    "gyro_visits": lambda s: gyroscope.normalize(TD.raw_visits(s)),
    "gyro_workouts": lambda s: gyroscope.normalize(TD.raw_workouts(s)),
    "gyro_sleep": lambda s: gyroscope.normalize(TD.raw_gyro_sleep(s)),
    # every activity-app layout through one plan (how the file pipeline reads them)
    "gyro_all": lambda s: gyroscope.normalize(gyroscope.union_raw(
        [TD.raw_steps(s), *TD.raw_vitals(s).values(), TD.raw_visits(s), TD.raw_workouts(s),
         TD.raw_gyro_sleep(s)])),
    "sleep_quality": lambda s: sleep.normalize(TD.raw_sleep(s)["quality"]),
    "sleep_simple": lambda s: sleep.normalize(TD.raw_sleep(s)["simple"]),
    "sleep_detailed": lambda s: sleep.normalize(TD.raw_sleep(s)["detailed"]),
    "sleep_generic": lambda s: sleep.normalize(TD.raw_sleep_generic(s)),
    "habits": lambda s: coach.normalize(TD.raw_habits(s)),
    **{f"manual_{k}": (lambda s, k=k: manual.normalize(TD.raw_manual(s)[k]))
       for k in ["migraine", "symptoms", "medication", "mood", "pain", "weight",
                 "blood_pressure", "glucose", "general"]},
    "moves_activities": lambda s: moves.normalize_csv(TD.raw_moves_activities(s), "activities"),
    "moves_places": lambda s: moves.normalize_csv(TD.raw_moves_places(s), "places"),
    "moves_storyline_csv": lambda s: moves.normalize_csv(TD.raw_moves_storyline_csv(s), "storyline"),
    "moves_summary": lambda s: moves.normalize_csv(TD.raw_moves_summary(s), "summary"),
    "moves_generic": lambda s: moves.normalize_csv(TD.raw_moves_generic(s), "daily"),
    "moves_json_activities": lambda s: moves.normalize_json(TD.raw_moves_json_activity_items(s),
                                                            "activities"),
    "moves_places_json": lambda s: moves.normalize_json(TD.raw_moves_places_json(s), "places"),
    "moves_storyline_json": lambda s: moves.normalize_json(TD.raw_storyline(s), "storyline"),
    "nike": lambda s: nike.normalize(TD.raw_minutes(s)),
    "apple": lambda s: apple.normalize(TD.raw_xml(s)),
}
GYRO = ["gyro_steps", "gyro_vitals", "gyro_visits", "gyro_workouts", "gyro_sleep"]
SLEEP = ["sleep_quality", "sleep_simple", "sleep_detailed", "sleep_generic"]
MANUAL = [k for k in LAYOUTS if k.startswith("manual_")]
MOVES = [k for k in LAYOUTS if k.startswith("moves_")]


LAYOUTS_AT_ONCE = 8
ALL_LAYOUTS = tuple(k for k in LAYOUTS if not k.startswith("gyro_")) + ("gyro_all",)


def pre(spark: SparkSession, *names: str) -> DataFrame:
    names = names or ALL_LAYOUTS

    def layout(n):
        return _memo("layout", spark, (n,), lambda: LAYOUTS[n](spark))

    def build():
        with ThreadPoolExecutor(min(len(names), LAYOUTS_AT_ONCE)) as pool:
            return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(spark)(layout), names))

    return _memo("pre", spark, names, build)


def fin(spark: SparkSession, *names: str) -> DataFrame:
    """Finalised rows (records + rejects, ``reason`` set on rejects), as a plan.

    Nothing is stored: a query computes the columns that it reads, of the
    layouts that its filters leave.
    """
    return _memo("fin", spark, names, lambda: finalize(pre(spark, *names)))


def recs(spark: SparkSession, *names: str) -> DataFrame:
    return _memo("recs", spark, names, lambda: valid(fin(spark, *names)))


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once and read back from the shared folder by all that is made of it."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def recs_outline(spark: SparkSession, *names: str) -> DataFrame:
    """The valid records without raw text and copy numbers, also in their ids.

    For checks that ask of an id only whether it is there, which depends on
    neither (see :func:`record_id`): no row is shuffled to number its copies.
    """
    return _memo("outline", spark, names, lambda: valid(finalize(pre(spark, *names).withColumns(
        {"occurrence": F.lit(1).cast("bigint"), "raw_data": F.lit(None).cast("string")}))))


# ------------------------------------------------------------ column sugar --

def mv(name: str) -> Column:
    return F.col("metrics").getItem(name).getField("value")


def mu(name: str) -> Column:
    return F.col("metrics").getItem(name).getField("unit")


def mc(name: str) -> Column:
    return F.col("metrics").getItem(name).getField("confidence")


def at(name: str) -> Column:
    return F.col("attrs").getItem(name)


def tm(name: str) -> Column:
    return F.date_format(F.col("times").getItem(name), "MM/dd/yyyy HH:mm:ss")


def ts_out(col: str = "timestamp") -> Column:
    return F.date_format(F.col(col), "MM/dd/yyyy HH:mm:ss")


def day_out(col: str = "date_only") -> Column:
    return F.date_format(F.col(col), "yyyy-MM-dd")
