"""Write derived rows as export files named like the apps name them.

Each task writes a file for every ``origin`` (export file name) among its
rows, through Spark's commit protocol; AQE splits an origin that is large.
The files then get their export names (a metadata-only rename per file,
never per row).  Used to exercise the file readers at full table size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_named(spark: SparkSession, df: DataFrame, base: str, fmt: str = "csv",
                options: dict | None = None, name_col: str = "origin") -> list[str]:
    """Write ``df`` into one or more files per distinct ``name_col`` under ``base``.

    Returns the final file paths: ``base/<origin>``, further ones in ``base/p1``
    and so on.  ``origin`` values may contain sub-directories.
    """
    staging = f"{base.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    w = df.hint("rebalance", name_col).write.partitionBy(name_col).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(staging)
    store, root = _fs(spark, staging)
    jvm = spark._jvm
    out = []
    for st in store.listStatus(root):
        name = st.getPath().getName()
        if not st.isDirectory() or not name.startswith(f"{name_col}="):
            continue
        origin = unquote(name[len(name_col) + 1:])
        parts = [f for f in store.listStatus(st.getPath())
                 if f.getPath().getName().startswith("part-")]
        for i, f in enumerate(sorted(parts, key=lambda s: s.getPath().getName())):
            target = f"{base.rstrip('/')}/{origin}" if i == 0 else \
                f"{base.rstrip('/')}/p{i}/{origin}"
            tp = jvm.org.apache.hadoop.fs.Path(target)
            store.mkdirs(tp.getParent())
            store.rename(f.getPath(), tp)
            out.append(target)
    return sorted(out)


def _written_each(batches, base: str):
    """Each row's ``value`` as a file called ``name``; a task run again writes the same files."""
    store, place = fs.FileSystem.from_uri(base if "://" in base else "file://" + base.removeprefix("file:"))
    n = 0
    for b in batches:
        for name, value in zip(b.column("name").to_pylist(), b.column("value").to_pylist()):
            with store.open_output_stream(f"{place}/{name}") as out:
                out.write(value.encode())
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array([n])], ["files"])


def make_folder(spark: SparkSession, path: str) -> None:
    f, p = _fs(spark, path)
    f.mkdirs(p)


def write_each(spark: SparkSession, rows: DataFrame, base: str) -> int:
    """One small file for each row (name, value) in the folder ``base``, written by the tasks."""
    make_folder(spark, base)
    wrote = rows.select("name", "value").mapInArrow(partial(_written_each, base=base), "files long")
    return wrote.agg(F.sum("files")).first()[0] or 0


#: small files there are at a time: each takes a block of disk, however short its text
FILES_AT_ONCE = 1 << 17


def drop_folder(spark: SparkSession, path: str) -> None:
    f, p = _fs(spark, path)
    f.delete(p, True)


def scan_each(spark: SparkSession, rows: DataFrame, base: str, scan: Callable[[str], DataFrame],
              at_once: int = FILES_AT_ONCE) -> DataFrame:
    """What ``scan`` makes of a folder of files, one for each row (name, value).

    The files are written, scanned and removed ``at_once`` at a time.  Rows
    are staged in files of at most an eighth of that, of which only names and
    row counts reach the driver.
    """
    texts, found = f"{base}/texts", f"{base}/found"
    rows.select("name", "value").write.option("maxRecordsPerFile", max(1, at_once // 8)).parquet(texts)
    staged = spark.read.schema(rows.select("name", "value").schema).parquet(texts)
    parts = staged.groupBy(F.col("_metadata.file_path").alias("path")).count().orderBy("path").collect()
    batches: list[list[str]] = [[]]
    n = 0
    for r in parts:
        if n + r["count"] > at_once and batches[-1]:
            batches.append([])
            n = 0
        batches[-1].append(r["path"])
        n += r["count"]
    schema = None
    for i, paths in enumerate(batches):
        folder = f"{base}/files-{i}"
        make_folder(spark, folder)
        if paths:
            write_each(spark, spark.read.schema(staged.schema).parquet(*paths), folder)
        out = scan(folder)
        schema = out.schema
        out.write.mode("append").parquet(found)
        drop_folder(spark, folder)
    drop_folder(spark, texts)
    return spark.read.schema(schema).parquet(found)


def remove_files(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        f, p = _fs(spark, path)
        f.delete(p, False)


def write_json_arrays(spark: SparkSession, items: DataFrame, base: str, per_file: int = 1000) -> list[str]:
    """Items (with ``origin``) as files that each hold one top-level JSON array."""
    cols = [c for c in items.columns if c != "origin"]
    files = max(1, -(-items.count() // per_file))
    h = F.pmod(F.xxhash64(*cols), F.lit(files))
    arrays = items.groupBy("origin", h.alias("chunk")).agg(
        F.to_json(F.collect_list(F.struct(*cols))).alias("value"))
    named = arrays.select("value", F.concat("origin", F.lit("/"), F.col("chunk").cast("string")).alias("origin"))
    return write_named(spark, named, base, "text")
