"""Queries for scans, discovery, sinks, incremental ingestion and data quality
(survey §2.1, §2.2, §2.12–§2.14).

Scans write the derived export rows as real files (named like the apps
name them) into the shared folder and read them back through the readers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaldf import functions as V
from vitaldf.operators import quality as DQ
from vitaldf.operators import tables as TB
from vitaldf.operators.records import build_records, finalize, rejects
from vitaldf.operators.store import Store, sink_json_by_type
from vitaldf.plans import oracle as O
from vitaldf.plans import testdata as TD
from vitaldf.plans.exports import remove_files, scan_each, write_json_arrays, write_named
from vitaldf.plans.q_tables import ALL_OK, _discover_rules_sql, _inventory_spark, _table_counts_sql, \
    claimed_sql, inventory_sql
from vitaldf.plans.registry import fin, q, recs, recs_outline, staged, ts_out
from vitaldf.schema import MANUAL_TYPES, PROCESSOR_COUNT
from vitaldf.session import shared_dir
from vitaldf.sources import apple, files, gyroscope, moves, nike, pipeline, sleep
from vitaldf.streaming.incremental import incremental_batch, incremental_stream

D = TD.DUCK
R = O.orender
CSV_OPTS = {"header": "true", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "escape": '"'}


def ok(sql: str) -> str:
    return f"SELECT * FROM ({sql}) t WHERE ts IS NOT NULL"


def _ts():
    return ts_out().alias("timestamp")


def _write_csv(spark, df, name, sep=",", encoding=None):
    opts = dict(CSV_OPTS, sep=sep)
    if encoding:
        opts["encoding"] = encoding
    return write_named(spark, df, shared_dir(spark, name), "csv", opts)


# ------------------------------------------------------------------ scans --

@q("scan_csv_header", lambda: f"""
    SELECT sub_type, {R('ts')} AS timestamp, steps FROM ({ok(O.o_gyro_steps())}) t""")
def scan_csv_header(spark):
    paths = _write_csv(spark, TD.raw_steps(spark), "export-gyro")
    r = build_records(reduce(DataFrame.unionByName, pipeline.read_gyroscope(spark, paths)))
    return r.select("sub_type", _ts(), F.col("metrics")["steps"]["value"].alias("steps"))


@q("scan_csv_sniffed", lambda: f"""
    SELECT {R('ts')} AS timestamp, CAST(sleep_duration AS DOUBLE) AS sleep_duration, sleep_quality
    FROM ({ok(O.o_sleep_quality())}) t""")
def scan_csv_sniffed(spark):
    paths = _write_csv(spark, TD.raw_sleep(spark)["quality"], "export-sleep", sep=";")
    r = build_records(reduce(DataFrame.unionByName, pipeline.read_sleep(spark, paths)))
    return r.select(_ts(), F.col("metrics")["sleep_duration"]["value"].alias("sleep_duration"),
                    F.col("metrics")["sleep_quality"]["value"].alias("sleep_quality"))


@q("scan_csv_coach", lambda: f"""
    SELECT habit_name, habit_category, checkin_count, streak_days FROM ({ok(O.o_habits())}) t""")
def scan_csv_coach(spark):
    paths = _write_csv(spark, TD.raw_habits(spark), "export-coach")
    r = build_records(reduce(DataFrame.unionByName, pipeline.read_coach(spark, paths)))
    m = F.col("metrics")
    return r.select(F.col("attrs")["habit_name"].alias("habit_name"),
                    F.col("attrs")["habit_category"].alias("habit_category"),
                    m["checkin_count"]["value"].alias("checkin_count"),
                    m["streak_days"]["value"].alias("streak_days"))


def _manual_union_sql():
    parts = [f"SELECT sub_type, ts FROM ({p}) p" for p in O.o_manual().values()]
    u = " UNION ALL ".join(parts)
    return f"SELECT sub_type, {R('ts')} AS timestamp FROM ({u}) u WHERE ts IS NOT NULL"


@q("scan_csv_manual", _manual_union_sql)
def scan_csv_manual(spark):
    paths = []
    for k, df in TD.raw_manual(spark).items():
        paths += _write_csv(spark, df, f"export-manual-{k}")
    r = build_records(reduce(DataFrame.unionByName, pipeline.read_manual(spark, paths)))
    return r.select("sub_type", _ts())


@q("scan_csv_moves", lambda: f"""
    SELECT sub_type, {R('ts')} AS timestamp FROM ({ok(O.o_moves_activities())}) a
    UNION ALL SELECT sub_type, {R('ts')} FROM ({ok(O.o_moves_places())}) b
    UNION ALL SELECT sub_type, {R('ts')} FROM ({ok(O.o_moves_summary())}) c""")
def scan_csv_moves(spark):
    paths = []
    for name, df in [("act", TD.raw_moves_activities(spark)), ("pl", TD.raw_moves_places(spark)),
                     ("sum", TD.raw_moves_summary(spark))]:
        paths += _write_csv(spark, df, f"export-moves-{name}")
    r = build_records(reduce(DataFrame.unionByName, pipeline.read_moves(spark, paths)))
    return r.select("sub_type", _ts())


@q("scan_json_array", lambda: f"""
    SELECT {R('ts')} AS timestamp, activity_type, duration, distance
    FROM ({ok(O.o_moves_json_activities())}) t""")
def scan_json_array(spark):
    """Files that each hold one top-level array of items."""
    items = TD.raw_moves_json_activity_items(spark)
    paths = write_json_arrays(spark, items, shared_dir(spark, "export-mjson"))
    raw = moves.read_json(spark, paths, "activities")
    r = build_records(moves.normalize_json(raw, "activities"))
    return r.select(_ts(), F.col("attrs")["activity_type"].alias("activity_type"),
                    F.col("metrics")["duration"]["value"].alias("duration"),
                    F.col("metrics")["distance"]["value"].alias("distance"))


@q("scan_json_document", lambda: f"""
    SELECT origin, {R('ts')} AS timestamp, steps, fuel_points FROM ({ok(O.o_nike_summary())}) t""")
def scan_json_document(spark):
    """Every document in a file of its own, whose name holds its date."""
    docs = TD.raw_minutes(spark)
    text = F.to_json(F.struct(*[c for c in docs.columns if c != "origin"]))

    def scan(folder):
        r = build_records(nike.normalize(nike.read(spark, [folder]))).filter(F.col("sub_type") == "activity")
        return r.select(V.file_name(F.col("origin")).alias("origin"), _ts(),
                        F.col("metrics")["steps"]["value"].alias("steps"),
                        F.col("metrics")["fuel_points"]["value"].alias("fuel_points"))
    return scan_each(spark, docs.select(F.col("origin").alias("name"), text.alias("value")),
                     shared_dir(spark, "export-nike"), scan)


# The XML export is written without a line for each element: some tags span
# lines, others share one, and every 50th (by hash) repeats an attribute.
_XML_HASH = "(('0x' || substr(md5(line), 1, 8))::BIGINT)"
_XML_GOOD, _XML_BAD = f"{_XML_HASH} % 50 <> 0", f"{_XML_HASH} % 50 = 0"


def _xml_files(spark):
    lines = TD.raw_xml(spark)
    h = F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("bigint")
    text = F.when(h % 50 == 0, F.replace("line", F.lit(" startDate="), F.lit(' startDate="x" startDate=')))
    text = text.when(h % 3 == 0, F.replace("line", F.lit(" sourceVersion="), F.lit("\n   sourceVersion =  ")))
    text = text.otherwise(F.concat("line", F.lit('<MetadataEntry key="k" value="&lt;v>"/>')))
    rows = lines.select("origin", text.alias("value"))
    return write_named(spark, rows, shared_dir(spark, "export-apple"), "text", {"lineSep": " "})


@q("scan_xml_records", lambda: f"""
    SELECT {R('ts')} AS timestamp, data_type, sub_type, value, unit
    FROM ({ok(O.o_apple_records(_XML_GOOD))}) t
    UNION ALL SELECT NULL, 'unknown', lower(tag), NULL, NULL
    FROM ({TD.xml_lines_sql(D)}) x WHERE {_XML_BAD}""")
def scan_xml_records(spark):
    """Records of the export, and the malformed elements as rejects."""
    r = finalize(apple.normalize(apple.read(spark, _xml_files(spark))))
    r = r.filter((F.col("sub_type") != "workout") & F.col("reason").isNull()
                 | (F.col("reason") == "Malformed element"))
    key = F.try_element_at(F.filter(F.map_keys("metrics"),
                                    lambda k: ~k.isin("duration", "sleep_duration")), F.lit(1))
    return r.select(_ts(), "data_type", "sub_type", F.col("metrics")[key]["value"].alias("value"),
                    F.col("metrics")[key]["unit"].alias("unit"))


@q("scan_xml_workouts", lambda: f"""
    SELECT {R('ts')} AS timestamp, workout_type, duration, calories, distance
    FROM ({ok(O.o_apple_workouts(_XML_GOOD))}) t""")
def scan_xml_workouts(spark):
    r = build_records(apple.normalize(apple.read(spark, _xml_files(spark))))
    r = r.filter(F.col("sub_type") == "workout")
    m = F.col("metrics")
    return r.select(_ts(), F.col("attrs")["workout_type"].alias("workout_type"),
                    m["duration"]["value"].alias("duration"), m["calories"]["value"].alias("calories"),
                    m["distance"]["value"].alias("distance"))


_XML_SAMPLE = "(('0x' || substr(md5(ltrim(line)), 1, 8))::BIGINT) % 10 = 0"


@q("scan_xml_sampled", lambda: f"""
    SELECT data_type, count(*) AS records FROM (
      SELECT data_type FROM ({ok(O.o_apple_records(_XML_SAMPLE))}) a
      UNION ALL SELECT data_type FROM ({ok(O.o_apple_workouts(_XML_SAMPLE))}) b) t GROUP BY 1""")
def scan_xml_sampled(spark):
    """Opt-in deterministic 1-in-10 hash sample of the elements (the
    sampling operator itself; the default path reads every element)."""
    lines = TD.raw_xml(spark).select("origin", F.col("line").alias("value"))
    paths = write_named(spark, lines, shared_dir(spark, "export-apple"), "text")
    r = build_records(apple.normalize(apple.sample(apple.read(spark, paths), every=10)))
    return r.groupBy("data_type").agg(F.count(F.lit(1)).alias("records"))


def _name_of(path):
    """An export file's name below its folder (later files of a name are in p1, p2, ...)."""
    return F.regexp_extract(path, r"([^/]+/export\.xml|[^/]+)$", 1)


@q("scan_text_lines", lambda: f"""
    SELECT origin, count(*) AS lines FROM ({TD.xml_lines_sql(D)}) x GROUP BY origin""")
def scan_text_lines(spark):
    lines = TD.raw_xml(spark).select("origin", F.col("line").alias("value"))
    paths = write_named(spark, lines, shared_dir(spark, "export-lines"), "text")
    t = files.scan_text_lines(spark, paths)
    return t.groupBy(_name_of("origin").alias("origin")).agg(F.count(F.lit(1)).alias("lines"))


# Notes of even sources are written in Latin-1, where their text allows, with
# two columns; the others in UTF-8 with three.
_LATIN1 = r"^[\x00-\xFF]*$"


@q("scan_encoding", lambda: """
    SELECT CASE WHEN regexp_matches(text, '^[\\x{00}-\\x{FF}]*$') AND length(source) % 2 = 0
                THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding,
           regexp_replace(text, '[\\n\\r]', ' ', 'g') AS note
    FROM documents""")
def scan_encoding(spark):
    """Every document's whole text, written and read back in two encodings and header groups."""
    docs = spark.table("documents").select(
        "doc_id", "source", F.regexp_replace("text", "[\n\r]", " ").alias("note"),
        (F.rlike("text", F.lit(r"(?s)" + _LATIN1)) & (F.length("source") % 2 == 0)).alias("latin"))
    name = F.concat(F.lit("notes_"), F.col("source"), F.lit(".csv"))
    latin = docs.filter("latin").select(name.alias("origin"), F.col("doc_id").alias("no"), "note")
    other = docs.filter(~F.col("latin")).select(
        F.concat(F.lit("utf8_"), name).alias("origin"), F.col("doc_id").alias("no"), "note", "source")
    opts = {"quoteAll": "true"}
    paths = write_named(spark, latin, shared_dir(spark, "export-latin1"), "csv",
                        {**CSV_OPTS, **opts, "encoding": "ISO-8859-1"})
    paths += write_named(spark, other, shared_dir(spark, "export-utf8"), "csv", {**CSV_OPTS, **opts})
    parts = []
    for (header, d, e), ps in files.header_groups(spark, paths).items():
        back = files.read_csv_group(spark, ps, d, e)
        # a file of the first kind that holds ASCII alone is UTF-8 as well
        first = F.lit("UTF-8" if "source" in header else "ISO-8859-1")
        parts.append(back.select(first.alias("encoding"), "note"))
    return reduce(DataFrame.unionByName, parts)


@q("scan_table", lambda: f"""
    SELECT sub_type, count(*) AS records FROM ({ALL_OK()}) t WHERE source = 'gyroscope' GROUP BY 1""")
def scan_table(spark):
    recs(spark).createOrReplaceTempView("vitaldf_records")
    return spark.sql("SELECT sub_type, count(*) AS records FROM vitaldf_records "
                     "WHERE source = :src GROUP BY sub_type", args={"src": "gyroscope"})


# Export lines in a text file for each user's day of the month, and each user's first day once more as an
# archive, which the inventory leaves out.
_INV_LINE = "coalesce(date, '') || ',' || coalesce(steps, '')"
_INV_NAME = "'d' || coalesce(right(date, 2), 'none') || '.csv'"


@q("scan_file_inventory", lambda: f"""
    SELECT regexp_extract(origin, '^(.*)-steps-export.csv$', 1) AS dir_name, {_INV_NAME} AS name, 'csv' AS ext,
           sum(strlen({_INV_LINE}) + 1)::BIGINT AS length, true AS dated
    FROM ({TD.steps_sql(D)}) s GROUP BY 1, 2""")
def scan_file_inventory(spark):
    """Names, folders, sizes and times of files below a root (a name's parts together), without archives."""
    lines = TD.raw_steps(spark).select(
        F.regexp_extract("origin", "^(.*)-steps-export.csv$", 1).alias("folder"), F.expr(_INV_NAME).alias("file"),
        F.expr(_INV_LINE).alias("value"))
    named = lines.select(F.concat_ws("/", "folder", "file").alias("origin"), "value")
    archived = lines.filter(F.col("file") == "d01.csv").select(
        F.concat(F.col("folder"), F.lit("/backup.zip")).alias("origin"), "value")
    root = shared_dir(spark, "export-inv")
    write_named(spark, named.unionByName(archived), root, "text")
    inv = files.scan_file_inventory(spark, root)
    recent = F.col("modificationTime").between(F.current_timestamp() - F.expr("interval 1 day"),
                                               F.current_timestamp() + F.expr("interval 1 day"))
    return inv.groupBy("dir_name", "name", "ext").agg(F.sum("length").alias("length"),
                                                      F.bool_and(recent).alias("dated"))


# ------------------------------------------------------ discovery / classify

def _discover_q(source: str):
    pred = dict(_discover_rules_sql())[source]

    def sql():
        return f"SELECT path FROM ({inventory_sql()}) i WHERE {pred}"

    @q(f"discover_{source.split('_')[0] if source != 'sleep_tracker' else 'sleep'}"
       if source not in ("nike_plus", "apple_health", "coach_me", "manual_health")
       else {"nike_plus": "discover_nike", "apple_health": "discover_apple",
             "coach_me": "discover_coach", "manual_health": "discover_manual"}[source], sql)
    def run(spark):
        inv = _inventory_spark(spark)
        return files.discover(inv, "/exports").filter(F.col("source") == source).select("path")
    return run


for _s in ["gyroscope", "nike_plus", "apple_health", "coach_me", "sleep_tracker", "manual_health",
           "moves"]:
    _discover_q(_s)


@q("classify_file_gyroscope", lambda: f"""
    SELECT path, COALESCE(NULLIF(regexp_extract(regexp_extract(path, '([^/]*)$', 1),
                 'gyroscope-\\w+-(\\w+)-export\\.csv', 1), ''), 'unknown') AS sub_type
    FROM ({inventory_sql()}) i WHERE {dict(_discover_rules_sql())['gyroscope']}""")
def classify_file_gyroscope(spark):
    inv = files.discover(_inventory_spark(spark), "/exports").filter(F.col("source") == "gyroscope")
    return inv.select("path", V.gyro_sub_type(F.col("path")).alias("sub_type"))


def _manual_origins_sql():
    m = TD.manual_sql(D)
    return " UNION ALL ".join(f"SELECT origin FROM ({s}) x" for s in m.values())


def _manual_type_cases():
    name = "lower(regexp_extract(origin, '([^/]*)$', 1))"
    return " ".join("WHEN " + " OR ".join(f"contains({name}, '{w}')" for w in words) + f" THEN '{label}'"
                    for label, words in MANUAL_TYPES)


@q("classify_file_manual", lambda: f"""
    SELECT origin, CASE {_manual_type_cases()} ELSE 'general' END AS health_type,
           count(*) AS rows FROM ({_manual_origins_sql()}) o GROUP BY 1, 2""")
def classify_file_manual(spark):
    u = reduce(DataFrame.unionByName, [d.select("origin") for d in TD.raw_manual(spark).values()])
    return u.groupBy("origin", V.classify_file_manual(F.col("origin")).alias("health_type")).agg(
        F.count(F.lit(1)).alias("rows"))


_MOVES_ORIGINS = [TD.moves_activities_sql, TD.moves_places_sql, TD.moves_storyline_csv_sql,
                  TD.moves_summary_sql, TD.moves_generic_sql]


@q("classify_file_moves", lambda: f"""
    SELECT origin, CASE regexp_replace(regexp_extract(origin, '([^/]*)$', 1), '\\.csv$', '')
             WHEN 'activities' THEN 'fitness' WHEN 'places' THEN 'location'
             WHEN 'storyline' THEN 'location' WHEN 'summary' THEN 'fitness' ELSE 'mixed' END AS data_type,
           count(*) AS rows
    FROM ({' UNION ALL '.join(f'SELECT origin FROM ({f(D)}) x' for f in _MOVES_ORIGINS)}) o GROUP BY 1, 2""")
def classify_file_moves(spark):
    u = reduce(DataFrame.unionByName, [TD.raw(spark, f(TD.SPARK)).select("origin")
                                       for f in _MOVES_ORIGINS])
    return u.groupBy("origin", V.classify_file_moves(F.col("origin")).alias("data_type")).agg(
        F.count(F.lit(1)).alias("rows"))


_HEADERS = ["Start;End;Sleep quality;Time in bed;Wake up;Sleep Notes", "start_time,end_time,service",
            "date,bedtime,sleep_duration,efficiency", "Night Date,Hours Slept,Score %"]


def _header_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {i} THEN '{h}'" for i, h in enumerate(_HEADERS)) + " END"


@q("classify_sleep_format", lambda: f"""
    SELECT header, CASE WHEN contains(lower(header), 'bedtime') OR contains(lower(header), 'sleep_start')
                        THEN 'detailed'
                        WHEN contains(lower(header), 'start') AND contains(lower(header), 'end')
                        THEN CASE WHEN contains(lower(header), 'quality') THEN 'quality' ELSE 'simple' END
                        ELSE 'unknown' END AS format, count(*) AS files
    FROM (SELECT {_header_case('o_orderkey % 4')} AS header FROM orders) h GROUP BY 1, 2""")
def classify_sleep_format(spark):
    h = spark.table("orders").select(
        F.element_at(F.array(*[F.lit(x) for x in _HEADERS]),
                     (F.col("o_orderkey") % 4 + 1).cast("int")).alias("header"))
    return h.groupBy("header", sleep.classify_sleep_format(F.col("header")).alias("format")).agg(
        F.count(F.lit(1)).alias("files"))


@q("analyze_sources", lambda: f"""
    SELECT source, count(*) AS files FROM ({claimed_sql()}) c GROUP BY 1""")
def analyze_sources(spark):
    claimed = files.discover(_inventory_spark(spark), "/exports")
    return claimed.groupBy("source").agg(F.count(F.lit(1)).alias("files"))


# ------------------------------------------------------------------ sinks --

@q("sink_json_by_type", lambda: f"""
    SELECT source, data_type, count(*) AS record_count FROM ({ALL_OK()}) t GROUP BY 1, 2""")
def sink_json_by_type_q(spark):
    path = shared_dir(spark, "json-out")
    sink_json_by_type(recs(spark), path)
    back = spark.read.json(path)
    return back.groupBy("source", "data_type").agg(F.count(F.lit(1)).alias("record_count"))


def _store(spark) -> Store:
    st = Store(spark, shared_dir(spark, "store"))
    st.upsert(recs(spark))
    return st


@q("sink_tables", _table_counts_sql)
def sink_tables(spark):
    st = _store(spark)
    parts = [st.table(n).select(F.lit(n).alias("table_name")) for n in TB.MAPPERS]
    return reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("row_count"))


@q("sink_rejects", lambda: f"""
    SELECT source, count(*) AS rejects FROM ({O.all_core()}) u WHERE NOT ok GROUP BY 1""")
def sink_rejects(spark):
    """A batch's rejects sunk twice, as a replay does; the batch is made once."""
    st = Store(spark, shared_dir(spark, "store-rejects"))
    batch = staged(spark, rejects(fin(spark)), "rejects")
    for _ in range(2):
        st.replace_rejects(batch)
    return st.rejects().groupBy("source").agg(F.count(F.lit(1)).alias("rejects"))


def _steps_files(spark):
    return _write_csv(spark, TD.raw_steps(spark), "export-steps")


# Sorted text files of about 100 000 lines, so that SQL knows their content.
_LINE = "coalesce(date, '') || ',' || coalesce(steps, '') || ',' || coalesce(service, '')"


def _checksum_sql():
    h = [f"('0x' || substr(md5(line), {i}, 8))::BIGINT" for i in (1, 9)]
    sums = " || ':' || ".join(f"sum(({x})::HUGEINT * no)::VARCHAR" for x in h)
    return f"""
    WITH l AS (SELECT origin, {_LINE} AS line FROM ({TD.steps_sql(D)}) s),
    p AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT
            % CAST(ceil((SELECT count(*) FROM l) / 100000.0) AS BIGINT) AS part FROM l),
    n AS (SELECT *, row_number() OVER (PARTITION BY origin, part ORDER BY line) AS no FROM p)
    SELECT origin, part, md5(sum(strlen(line) + 1)::VARCHAR || ':' || count(*)::VARCHAR || ':' || {sums}) AS checksum
    FROM n GROUP BY origin, part"""


@q("file_checksum", _checksum_sql)
def file_checksum(spark):
    steps = TD.raw_steps(spark)
    parts = -(-steps.count() // 100_000)
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in ("date", "steps", "service")])
    rows = steps.select("origin", line.alias("value"))
    part = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("bigint") % parts
    base = shared_dir(spark, "export-lines")
    (rows.withColumn("part", part).repartition("origin", "part")
     .sortWithinPartitions("origin", "part", "value").write.partitionBy("origin", "part").text(base))
    cs = files.file_checksum(spark, [base])
    return cs.select(F.regexp_extract("path", "origin=([^/]*)", 1).alias("origin"),
                     F.regexp_extract("path", "part=([^/]*)", 1).cast("long").alias("part"), "checksum")


@q("sink_manifest", lambda: """
    SELECT DISTINCT 'gyroscope-u' || CAST(l_suppkey % 10 AS VARCHAR) || '-steps-export.csv' AS file,
           true AS current FROM lineitem""")
def sink_manifest(spark):
    """Manifest entries after a second update in which every checksum changed."""
    st = Store(spark, shared_dir(spark, "store-manifest"))
    now = files.file_checksum(spark, _steps_files(spark))
    st.update_manifest(now.withColumn("checksum", F.lit("stale")))
    st.update_manifest(now)
    return st.manifest().groupBy(_name_of("path").alias("file")).agg(
        F.bool_and(F.col("checksum") != "stale").alias("current"))


_VERSION_2 = """
    CASE origin WHEN 'gyroscope-u1-steps-export.csv' THEN '7' ELSE steps END AS steps"""
_KEPT_2 = """origin <> 'gyroscope-u3-steps-export.csv'
    AND (origin <> 'gyroscope-u2-steps-export.csv' OR service = 'manual')"""


@q("incremental_batch", lambda: f"""
    SELECT origin, count(*) AS records, sum(steps) AS steps, false AS processed_again
    FROM ({ok(O.o_gyro_steps().replace(TD.steps_sql(D), f"""
        SELECT origin, date, {_VERSION_2}, service FROM ({TD.steps_sql(D)}) v1 WHERE {_KEPT_2}"""))}) t
    GROUP BY origin""")
def incremental_batch_q(spark):
    """Records left after one file was rewritten, one shrunk, one deleted, and nothing the third time."""
    st = Store(spark, shared_dir(spark, "store-incr"))
    steps = TD.raw_steps(spark)
    paths = _write_csv(spark, steps, "export-v1")
    incremental_batch(spark, st, {"gyroscope": paths})
    changed = [f"gyroscope-u{i}-steps-export.csv" for i in (1, 2, 3)]
    remove_files(spark, [p for p in paths if p.rsplit("/", 1)[1] in changed])
    base = min(paths, key=len).rsplit("/", 1)[0]
    v2 = steps.filter(F.col("origin").isin(changed)).filter(F.expr(_KEPT_2)).withColumn(
        "steps", F.expr(_VERSION_2.replace(" AS steps", "")))
    paths = [p for p in paths if p.rsplit("/", 1)[1] not in changed]
    paths += write_named(spark, v2, base, "csv", dict(CSV_OPTS, sep=","))
    incremental_batch(spark, st, {"gyroscope": paths})
    again = incremental_batch(spark, st, {"gyroscope": paths}).count()
    return st.records().groupBy(_name_of("origin").alias("origin")).agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.col("metrics")["steps"]["value"]).alias("steps")
    ).withColumn("processed_again", F.lit(again > 0))


@q("incremental_stream", lambda: f"""
    SELECT {R('ts')} AS timestamp, count(*) AS records, sum(steps) AS steps
    FROM ({ok(O.o_gyro_steps())}) t GROUP BY ts""")
def incremental_stream_q(spark):
    paths = _steps_files(spark)
    src_dir = min(paths, key=len).rsplit("/", 1)[0]
    st = Store(spark, shared_dir(spark, "store-stream"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("date", "steps", "service")])
    incremental_stream(spark, st, src_dir, schema, gyroscope.normalize, shared_dir(spark, "stream-ckpt"),
                       {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"})
    return st.records().groupBy("timestamp").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.col("metrics")["steps"]["value"]).alias("steps")
    ).select(_ts(), "records", "steps")


@q("reprocess_source", lambda: f"""
    SELECT source, count(*) AS records FROM ({ALL_OK()}) t GROUP BY 1""")
def reprocess_source(spark):
    st = _store(spark)
    # twice, as after a run that was cut off
    for _ in range(2):
        st.reprocess_source("sleep_tracker", recs(spark))
    return st.records().groupBy("source").agg(F.count(F.lit(1)).alias("records"))


# -------------------------------------------------------------- quality ----

_SOURCES = ["apple_health", "coach_me", "gyroscope", "manual_health", "moves", "nike_plus", "sleep_tracker"]
# records damaged for the checks: those of a source's first days of each month
_DAMAGED_SQL = "(day(ts) <= 2 * (list_position([" + ", ".join(f"'{x}'" for x in _SOURCES) + "], source) - 1))"


def _damaged(spark):
    """All records; from none (first source) to 12 days a month of each source without
    a timestamp and type."""
    days = 2 * (F.array_position(F.array(*[F.lit(x) for x in _SOURCES]), F.col("source")) - 1)
    bad = F.dayofmonth("timestamp") <= days
    r = recs_outline(spark)
    return r.withColumns({"timestamp": F.when(~bad, F.col("timestamp")),
                          "data_type": F.when(bad, F.lit("")).otherwise(F.col("data_type"))})


def _expected_sql():
    """(source, sub_type, ts, missing_fields) of every record of every layout."""
    def part(missing, sql):
        return f"SELECT source, sub_type, ts, {missing} AS missing_fields FROM ({ok(sql)}) t"

    def lacks(*fields):
        return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in fields) + ")"
    m = O.o_manual()
    fitness, vitals = "'steps,calories,distance'", "'heart_rate,blood_pressure'"
    apple_fields = " ".join(
        f"WHEN data_type = '{kind}' THEN concat_ws(',', " + ", ".join(
            f"CASE WHEN NOT ({cond}) THEN '{f}' END" for f, cond in fields) + ")"
        for kind, fields in [
            ("fitness", [(f, _apple_has(f)) for f in ("steps", "calories", "distance")]),
            ("health", [("heart_rate", _apple_has("heart_rate")),
                        ("blood_pressure", f"{_apple_has('bp_systolic')} OR {_apple_has('bp_diastolic')}")])])
    return " UNION ALL ".join([
        part("'calories,distance'", O.o_gyro_steps()),
        part("CASE WHEN calories IS NULL THEN 'steps,calories,distance' ELSE 'steps,distance' END",
             O.o_gyro_workouts()),
        part(f"CASE WHEN systolic IS NOT NULL THEN 'heart_rate' ELSE {vitals} END", O.o_gyro_vitals()),
        part("''", O.o_sleep_quality()),
        part(lacks("steps", "calories"), O.o_moves_activities()),
        part(lacks("calories"), O.o_moves_summary()),
        part(vitals, m["glucose"]),
        part("'heart_rate'", m["blood_pressure"]),
        part(f"CASE sub_type WHEN 'minute_steps' THEN 'calories,distance' "
             f"WHEN 'minute_calories' THEN 'steps,distance' ELSE {fitness} END", O.o_nike_minutes()),
        part(lacks("steps", "calories", "distance"), O.o_nike_summary()),
        *[part(vitals, m[k]) for k in _HEALTH_LOGS],
        part("''", O.o_gyro_sleep()), part("''", O.o_gyro_visits()), part("''", O.o_sleep_simple()),
        part("'sleep_start,sleep_end'", O.o_sleep_detailed()),
        part("'sleep_duration,sleep_start,sleep_end'", O.o_sleep_generic()),
        part("''", O.o_habits()), part("''", O.o_moves_places()), part("''", O.o_moves_places_json()),
        part(f"CASE WHEN data_type = 'fitness' THEN {fitness} ELSE '' END", O.o_moves_storyline_csv()),
        part("''", O.o_moves_generic()),
        part("CASE WHEN distance IS NULL THEN 'steps,calories,distance' ELSE 'steps,calories' END",
             O.o_moves_json_activities()),
        part("CASE WHEN data_type <> 'fitness' THEN '' WHEN distance IS NULL THEN 'steps,calories,distance' "
             "ELSE 'steps,calories' END", O.o_storyline_json()),
        part(f"CASE {apple_fields} ELSE '' END", O.o_apple_records()),
        part("concat_ws(',', 'steps', CASE WHEN calories IS NULL THEN 'calories' END, "
             "CASE WHEN distance IS NULL THEN 'distance' END)", O.o_apple_workouts())])


def _apple_has(field):
    """Whether an element's record has the metric, which is kept where the element has a value."""
    return f"(metric_name = '{field}' AND value IS NOT NULL)"


_HEALTH_LOGS = ("migraine", "symptoms", "medication", "mood", "pain", "weight", "general")


@q("dq_expected_fields", lambda: f"""
    SELECT sub_type, missing_fields, count(*) AS records FROM ({_expected_sql()}) e GROUP BY 1, 2""")
def dq_expected_fields(spark):
    c = DQ.dq_expected_fields(recs(spark))
    return c.groupBy("sub_type", F.array_join("missing_schema", ",").alias("missing_fields")).agg(
        F.count(F.lit(1)).alias("records"))


@q("dq_required_fields", lambda: f"""
    SELECT source, count(*) FILTER (WHERE {_DAMAGED_SQL}) AS missing FROM ({ALL_OK()}) t GROUP BY 1""")
def dq_required_fields(spark):
    c = DQ.dq_required_fields(_damaged(spark))
    return c.groupBy("source").agg(F.count_if(F.size("missing_fields") > 0).alias("missing"))


@q("dq_timestamp_format", lambda: f"""
    SELECT source, count(*) FILTER (WHERE NOT COALESCE(
             regexp_full_match(ts_text, '\\d{{2}}/\\d{{2}}/\\d{{4}} \\d{{2}}:\\d{{2}}:\\d{{2}}')
             AND try_strptime(ts_text, '%m/%d/%Y %H:%M:%S') IS NOT NULL, false)) AS invalid
    FROM ({O.all_core()}) t GROUP BY 1""")
def dq_timestamp_format(spark):
    """Timestamp texts as exported, rejects included, that are not in the canonical format."""
    c = DQ.dq_timestamp_format(fin(spark), "ts_text")
    return c.groupBy("source").agg(F.count_if(~F.col("timestamp_ok")).alias("invalid"))


@q("dq_summary", lambda: f"""
    SELECT source, count(*) AS total_records, count(*) FILTER (WHERE NOT {_DAMAGED_SQL}) AS valid_records,
           count(*) FILTER (WHERE {_DAMAGED_SQL}) AS invalid_records,
           count(*) FILTER (WHERE {_DAMAGED_SQL}) AS date_issues,
           count(*) FILTER (WHERE NOT {_DAMAGED_SQL} AND missing_fields <> '') AS schema_violations
    FROM ({_expected_sql()}) t GROUP BY 1""")
def dq_summary(spark):
    """A damaged record, which has no type, violates no schema."""
    return DQ.dq_summary(_damaged(spark))


def _score_sql():
    return f"""
    SELECT source, count(*) AS n, count(*) FILTER (WHERE NOT {_DAMAGED_SQL}) AS ts_ok,
           count(*) FILTER (WHERE NOT {_DAMAGED_SQL}) AS schema_ok,
           CAST(round(count(*) FILTER (WHERE NOT {_DAMAGED_SQL}) / count(*) * 30
                      + count(*) FILTER (WHERE NOT {_DAMAGED_SQL}) / count(*) * 40
                      + count(*) FILTER (WHERE NOT {_DAMAGED_SQL}) / count(*) * 30) AS BIGINT) AS score
    FROM ({ALL_OK()}) t GROUP BY source"""


@q("dq_score_records", _score_sql)
def dq_score_records(spark):
    return DQ.dq_score_records(_damaged(spark), by=("source",))


_GRADE = """CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 80 THEN 'production_ready'
                WHEN score >= 70 THEN 'needs_improvement' ELSE 'not_production_ready' END"""


@q("dq_grade", lambda: f"SELECT source, score, {_GRADE} AS grade FROM ({_score_sql()}) s")
def dq_grade(spark):
    s = DQ.dq_score_records(_damaged(spark), by=("source",))
    return s.select("source", "score", DQ.dq_grade(F.col("score")).alias("grade"))


def _recognition_sql():
    return f"""
    SELECT count(*) AS total_files, count(c.path) AS recognized_files,
           count(*) - count(c.path) AS unrecognized_files,
           CASE WHEN count(*) > 0 THEN count(c.path) / count(*) ELSE 0.0 END AS recognition_rate
    FROM ({inventory_sql()}) i LEFT JOIN (SELECT DISTINCT path FROM ({claimed_sql()}) x) c ON i.path = c.path"""


def _recognition(spark):
    inv = _inventory_spark(spark)
    return DQ.dq_recognition(inv, files.discover(inv, "/exports"))


@q("dq_recognition", _recognition_sql)
def dq_recognition(spark):
    return _recognition(spark)


def _discovery_sql():
    return f"""
    SELECT count(*) FILTER (WHERE bad) AS errors, count(DISTINCT source) FILTER (WHERE some_ok) AS ok_sources
    FROM (SELECT source, origin, bool_or(NOT ok) AS bad, bool_or(ok) AS some_ok
          FROM ({O.all_core()}) u GROUP BY source, origin) f"""


@q("dq_score_discovery", lambda: f"""
    SELECT total_files, recognized_files, unrecognized_files, recognition_rate, score, {_GRADE} AS grade
    FROM (SELECT r.*, CAST(round(recognition_rate * 40
             + (1 - least(errors, total_files) / greatest(total_files, 1)) * 30
             + least(ok_sources, 6) / 6 * 30) AS BIGINT) AS score
          FROM ({_recognition_sql()}) r, ({_discovery_sql()}) d) s""")
def dq_score_discovery(spark):
    """Errors are files with rejects, and a processor is fine if it made a record."""
    found = DQ.dq_processor_profile(fin(spark)).agg(
        F.count_if(F.col("errors") > 0), F.count_distinct(F.when(F.col("records") > 0, F.col("source")))).first()
    return DQ.dq_score_discovery(_recognition(spark), F.least(F.lit(found[0]), F.col("total_files")),
                                 min(found[1], PROCESSOR_COUNT))


def _metrics_sql():
    """Per source: its share of the recognised files, its score, its files without a record."""
    return f"""
    SELECT s.source, s.score, COALESCE(c.files, 0) / (SELECT count(*) FROM ({inventory_sql()}) i) AS rate,
           COALESCE(f.failed, 0) AS failed
    FROM ({_score_sql()}) s
    LEFT JOIN (SELECT source, count(*) AS files FROM ({claimed_sql()}) x GROUP BY 1) c ON s.source = c.source
    LEFT JOIN (SELECT source, count(*) AS failed FROM (
        SELECT source, origin FROM ({O.all_core()}) u GROUP BY source, origin HAVING NOT bool_or(ok)) y
        GROUP BY 1) f ON s.source = f.source"""


@q("dq_recommendations", lambda: f"""
    SELECT source, priority, issue FROM (
      SELECT source, 'HIGH' AS priority, 'Low file recognition rate' AS issue, rate * 100 < 50 AS hit
      FROM ({_metrics_sql()}) r
      UNION ALL SELECT source, 'HIGH', 'Data quality below enterprise standard', score < 80 FROM ({_metrics_sql()}) r
      UNION ALL SELECT source, 'MEDIUM', 'Some processors failed', failed > 0 FROM ({_metrics_sql()}) r) t WHERE hit""")
def dq_recommendations(spark):
    inv = _inventory_spark(spark)
    total = max(1, inv.count())
    share = files.discover(inv, "/exports").groupBy("source").agg((F.count(F.lit(1)) / total).alias("rate"))
    failed = (DQ.dq_processor_profile(fin(spark)).filter(F.col("records") == 0)
              .groupBy("source").agg(F.count(F.lit(1)).alias("failed")))
    base = (DQ.dq_score_records(_damaged(spark), by=("source",)).join(share, "source", "left")
            .join(failed, "source", "left").fillna(0, ["rate", "failed"]))
    return DQ.dq_recommendations(F.col("rate"), F.col("score"), F.col("failed"), base, keep=("source",))


@q("dq_processor_profile", lambda: f"""
    SELECT source, regexp_extract(origin, '([^/]*)$', 1) AS origin,
           count(*) FILTER (WHERE ok) AS records, count(*) FILTER (WHERE NOT ok) AS errors,
           CASE WHEN count(*) FILTER (WHERE ok) > 0 THEN 'success'
                WHEN count(*) FILTER (WHERE NOT ok) > 0 THEN 'error' ELSE 'no_records' END AS status
    FROM ({O.all_core()}) u GROUP BY source, u.origin""")
def dq_processor_profile(spark):
    p = DQ.dq_processor_profile(fin(spark))
    return p.select("source", F.regexp_extract("origin", r"([^/]*)$", 1).alias("origin"),
                    "records", "errors", "status")

