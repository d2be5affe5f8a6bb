"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaldf.session import shared_dir


ARROW_BATCH = "8m"
#: the folder that holds the package
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_ready(spark: SparkSession) -> None:
    """What the operators need of a session.

    Arrow batches are bounded by bytes, since texts may be long.  Python
    workers on this machine import the package from where the driver did; on
    other machines it is installed, or sent with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    make_ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: later jobs read files that every executor sees, so a
    lost executor costs no more than the tasks it was running.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._saved_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``saved`` made and that nothing still to run reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._saved_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def n_blocks(rows: int, rows_per_block: int) -> int:
    """Blocks needed so that each holds about ``rows_per_block`` rows."""
    return max(1, -(-rows // rows_per_block))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
