"""Independent SQL (DuckDB) rendition of the normalisers, for the oracle check.

Each ``o_*`` function returns a SELECT over one adapter's text with the
columns the Spark job produces for that layout.  Shared core columns:
origin, source, data_type, sub_type, ts_text, ts (TIMESTAMP, NULL = reject).
"""

from __future__ import annotations

from vitaldf.plans import testdata as TD

D = TD.DUCK
SQ = "'"

# fixed format shapes recognised by the oracle's timestamp parser
_SHAPES = [
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "try_strptime({t}, '%Y-%m-%d %H:%M:%S')"),
    (r"\d{4}-\d{2}-\d{2}-\d{2}:\d{2}:\d{2}", "try_strptime({t}, '%Y-%m-%d-%H:%M:%S')"),
    (r"\d{4}-\d{2}-\d{2}", "try_strptime({t}, '%Y-%m-%d')"),
    (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}", "try_strptime({t}, '%m/%d/%Y %H:%M:%S')"),
    (r"\d{2}/\d{2}/\d{4}", "try_strptime({t}, '%m/%d/%Y')"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} [+-]\d{4}",
     "try_strptime(left({t}, 19), '%Y-%m-%d %H:%M:%S') - to_minutes("
     "CAST((CASE WHEN substr({t}, 21, 1) = '-' THEN -1 ELSE 1 END) * "
     "(CAST(substr({t}, 22, 2) AS INTEGER) * 60 + CAST(substr({t}, 24, 2) AS INTEGER)) AS BIGINT))"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}", "try_strptime(left({t}, 19), '%Y-%m-%d %H:%M:%S')"),
]


def ots(t: str) -> str:
    """Parse export timestamp text (NULL when blank or not a real instant)."""
    whens = " ".join(f"WHEN regexp_full_match({t}, '{rx}') THEN {expr.format(t=t)}"
                     for rx, expr in _SHAPES)
    return f"(CASE {whens} END)"


def orender(x: str) -> str:
    return f"strftime({x}, '%m/%d/%Y %H:%M:%S')"


def odate(x: str) -> str:
    return f"strftime({x}, '%m/%d/%Y')"


def onb(t: str) -> str:
    return f"(CASE WHEN trim({t}) <> '' THEN {t} END)"


def ofloat(t: str) -> str:
    return (f"TRY_CAST(NULLIF(regexp_extract({t}, "
            r"'^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)', 1), '') AS DOUBLE)")


def oint(t: str) -> str:
    return rf"TRY_CAST(NULLIF(regexp_extract({t}, '^\s*([+-]?\d+)', 1), '') AS DOUBLE)"


def ostrip(t: str) -> str:
    return f"(CASE WHEN {t} <> '' THEN {ofloat(f'regexp_replace({t}, {SQ}[^0-9.\\-]{SQ}, {SQ}{SQ}, {SQ}g{SQ})')} END)"


def odefault(v: str, default) -> str:
    return f"(CASE WHEN {v} IS NULL OR {v} = 0 THEN {default} ELSE {v} END)"


def odur(a: str, b: str) -> str:
    """Whole minutes between two export timestamps (truncated toward zero)."""
    return f"CAST(trunc(date_diff('second', {ots(a)}, {ots(b)}) / 60.0) AS BIGINT)"


def wrap(sql: str) -> str:
    return f"({sql})"


def core(source: str, data_type: str, sub_type: str, ts_text: str, extra: str = "") -> str:
    extra = f", {extra}" if extra.strip() else ""
    return (f"origin, '{source}' AS source, {data_type} AS data_type, {sub_type} AS sub_type, "
            f"{ts_text} AS ts_text, {ots(ts_text)} AS ts{extra}")


def _coalesce_nb(*cols: str) -> str:
    return "COALESCE(" + ", ".join(onb(c) for c in cols) + ")"


# ---------------------------------------------------------------- gyroscope -

def o_gyro_steps() -> str:
    return f"""SELECT {core('gyroscope', "'fitness'", "'steps'", 'date', f'''
        {odefault(oint('steps'), 0)} AS steps,
        CASE WHEN service = 'healthkit' THEN 0.9 ELSE 0.7 END::DOUBLE AS steps_confidence,
        service AS measurement_source''')}
    FROM {wrap(TD.steps_sql(D))} a"""


def o_gyro_vitals() -> str:
    parts = []
    v = TD.vitals_sql(D)
    ms = "COALESCE(" + onb("service") + ", 'gyroscope')"
    parts.append(f"""SELECT {core('gyroscope', "'health'", "'bp'", 'time', f'''
        CASE WHEN {ofloat(onb('systolic'))} > 0 AND {ofloat(onb('diastolic'))} > 0
             THEN {ofloat('systolic')} END AS systolic,
        CASE WHEN {ofloat(onb('systolic'))} > 0 AND {ofloat(onb('diastolic'))} > 0
             THEN {ofloat('diastolic')} END AS diastolic,
        NULL::DOUBLE AS glucose, NULL::DOUBLE AS hrv, NULL::DOUBLE AS rhr, NULL::VARCHAR AS mood,
        {ms} AS measurement_source''')} FROM {wrap(v['bp'])} a""")
    parts.append(f"""SELECT {core('gyroscope', "'health'", "'glucose'", 'time', f'''
        NULL::DOUBLE, NULL::DOUBLE,
        CASE WHEN {onb('glucose')} IS NOT NULL THEN {ofloat('glucose')} END,
        NULL::DOUBLE, NULL::DOUBLE, NULL::VARCHAR, {ms}''')} FROM {wrap(v['glucose'])} a""")
    parts.append(f"""SELECT {core('gyroscope', "'health'", "'hrv'", 'time', f'''
        NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE,
        CASE WHEN {onb('hrv')} IS NOT NULL THEN {ofloat('hrv')} END,
        NULL::DOUBLE, NULL::VARCHAR, {ms}''')} FROM {wrap(v['hrv'])} a""")
    rhr = _coalesce_nb("rhr", "heart_rate")
    parts.append(f"""SELECT {core('gyroscope', "'health'", "'rhr'", 'time', f'''
        NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE,
        {ofloat(rhr)}, NULL::VARCHAR, 'gyroscope' ''')} FROM {wrap(v['rhr'])} a""")
    parts.append(f"""SELECT {core('gyroscope', "'health'", "'mood'", 'time', f'''
        NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE,
        mood, {ms}''')} FROM {wrap(v['mood'])} a""")
    return " UNION ALL ".join(parts)


def o_gyro_visits() -> str:
    ok = f"({onb('\"Start Time\"')} IS NOT NULL AND {onb('\"End Time\"')} IS NOT NULL)"
    return f"""SELECT {core('gyroscope', "'location'", "'gvisits'",
                            _coalesce_nb('"Start Time"', '"End Time"'), f'''
        COALESCE({onb('"Name"')}, '') AS location_name,
        {ofloat(onb('"Latitude"'))} AS latitude, {ofloat(onb('"Longitude"'))} AS longitude,
        CASE WHEN {ok} THEN {ots('"Start Time"')} END AS visit_start,
        CASE WHEN {ok} THEN {ots('"End Time"')} END AS visit_end,
        CASE WHEN {ok} THEN {odur('"Start Time"', '"End Time"')} END AS visit_duration''')}
    FROM {wrap(TD.visits_sql(D))} a"""


def o_gyro_workouts() -> str:
    sub = r"regexp_extract(origin, 'gyroscope-\w+-(\w+)-export\.csv', 1)"
    return f"""SELECT {core('gyroscope', "'fitness'", sub, _coalesce_nb('start_time', 'end_time'), f'''
        id AS workout_id, COALESCE({onb('type')}, 'unknown') AS workout_type,
        COALESCE({onb('name')}, '') AS workout_name,
        {odur('start_time', 'end_time')} AS duration,
        CASE WHEN {onb('calories')} IS NOT NULL THEN {ofloat('calories')} END AS calories,
        {ots(onb('start_time'))} AS start_time, {ots('end_time')} AS end_time''')}
    FROM {wrap(TD.workouts_sql(D))} a"""


def o_gyro_sleep() -> str:
    return f"""SELECT {core('gyroscope', "'sleep'", "'sleep'", _coalesce_nb('start_time', 'end_time'), f'''
        {odur('start_time', 'end_time')} AS sleep_duration,
        {ots('start_time')} AS sleep_start, {ots('end_time')} AS sleep_end,
        service AS measurement_source''')}
    FROM {wrap(TD.gyro_sleep_sql(D))} a"""


# ---------------------------------------------------------------- sleep ----

def o_sleep_quality() -> str:
    tib = ("(TRY_CAST(NULLIF(regexp_extract(split_part(\"Time in bed\", ':', 1), '^\\s*([+-]?\\d+)', 1), '') AS BIGINT) * 60"
           " + TRY_CAST(NULLIF(regexp_extract(split_part(\"Time in bed\", ':', 2), '^\\s*([+-]?\\d+)', 1), '') AS BIGINT))")
    return f"""SELECT {core('sleep_tracker', "'sleep'", "'sleep_session'", '"Start"', f'''
        {odur('"Start"', '"End"')} AS sleep_duration,
        {ofloat(f"replace({onb('\"Sleep quality\"')}, '%', '')")} AS sleep_quality,
        CASE WHEN {tib} > 0 THEN CAST({tib} AS DOUBLE) END AS time_in_bed,
        {onb('"Wake up"')} AS wake_mood, {onb('"Sleep Notes"')} AS sleep_notes,
        {ots('"Start"')} AS sleep_start, {ots('"End"')} AS sleep_end''')}
    FROM {wrap(TD.sleep_quality_sql(D))} a"""


def o_sleep_simple() -> str:
    return f"""SELECT {core('sleep_tracker', "'sleep'", "'sleep_session'", 'start_time', f'''
        {odur('start_time', 'end_time')} AS sleep_duration,
        {onb('service')} AS measurement_source,
        {ots('start_time')} AS sleep_start, {ots('end_time')} AS sleep_end''')}
    FROM {wrap(TD.sleep_simple_sql(D))} a"""


def _sleep_unit(field: str, v: str) -> str:
    f = field.lower()
    if "percent" in f or "%" in f:
        return "'percent'"
    rest = ("hours" if "hour" in f else
            "minutes" if ("minute" in f or "duration" in f or "time" in f) else
            "count" if ("count" in f or "wake" in f) else "units")
    return f"(CASE WHEN {v} <= 1 AND {v} >= 0 THEN 'percent' ELSE '{rest}' END)"


def o_sleep_detailed() -> str:
    cols = {"sleep_duration": "sleep_duration", "sleep_efficiency": "efficiency",
            "deep_sleep": "deep_sleep", "rem_sleep": "rem", "awake_time": "awake",
            "wake_ups": "wake_ups"}
    extra = []
    for metric, col in cols.items():
        v = ostrip(col)
        extra.append(f"{v} AS {metric}, CASE WHEN {v} IS NOT NULL THEN {_sleep_unit(col, v)} END AS {metric}_unit")
    return f"""SELECT {core('sleep_tracker', "'sleep'", "'detailed_sleep'", 'date', ', '.join(extra))}
    FROM {wrap(TD.sleep_detailed_sql(D))} a"""


def o_sleep_generic() -> str:
    hv, sv = ostrip('"Hours Slept"'), ostrip('"Score %"')
    return f"""SELECT {core('sleep_tracker', "'sleep'", "'generic_sleep'", '"Night Date"', f'''
        {hv} AS hours_slept, CASE WHEN {hv} IS NOT NULL THEN {_sleep_unit('Hours Slept', hv)} END AS hours_slept_unit,
        {sv} AS score__, CASE WHEN {sv} IS NOT NULL THEN 'percent' END AS score___unit,
        {ostrip('"Mood"')} AS mood''')}
    FROM {wrap(TD.sleep_generic_sql(D))} a WHERE {onb('"Night Date"')} IS NOT NULL"""


# ---------------------------------------------------------------- habits ---

def o_habits() -> str:
    cats = []
    from vitaldf.schema import HABIT_CATEGORIES
    for label, words in HABIT_CATEGORIES:
        cond = " OR ".join(f"contains(lower(trim(\"Habit\")), '{w}')" for w in words)
        cats.append(f"WHEN {cond} THEN '{label}'")
    cat = "CASE " + " ".join(cats) + " ELSE 'other' END"
    return f"""SELECT {core('coach_me', "'habits'", "'habit_checkin'", '"Date"', f'''
        "Id" AS habit_id, trim("Habit") AS habit_name, {cat} AS habit_category,
        {odefault(oint('"Check In Count"'), 1)} AS checkin_count,
        {odefault(oint('"Days in Streak"'), 0)} AS streak_days,
        CASE WHEN "Prop Count" <> '' THEN {oint('"Prop Count"')} END AS prop_count,
        CASE WHEN "Comment Count" <> '' THEN {oint('"Comment Count"')} END AS comment_count,
        COALESCE({onb('"Note"')}, '') AS notes, "URL" AS url''')}
    FROM {wrap(TD.habits_sql(D))} a
    WHERE {onb('"Date"')} IS NOT NULL AND {onb('"Habit"')} IS NOT NULL"""


# ---------------------------------------------------------------- manual ---

def o_manual() -> dict[str, str]:
    m = TD.manual_sql(D)
    sev = "CASE severity WHEN 'L' THEN 'low' WHEN 'M' THEN 'medium' WHEN 'H' THEN 'high' ELSE severity END"
    score = f"COALESCE(CASE {sev} WHEN 'low' THEN 2.0 WHEN 'medium' THEN 3.0 WHEN 'high' THEN 4.0 END, 3.0)::DOUBLE"

    def sel(t, extra):
        return f"SELECT {core('manual_health', chr(39) + 'health' + chr(39), chr(39) + t + chr(39), 'date', extra)} FROM {wrap(m[t])} a"
    has_sev = f"{onb('severity')} IS NOT NULL"
    has_h = f"{onb('duration_hours')} IS NOT NULL"
    return {
        "migraine": sel("migraine", f"""
            CASE WHEN {has_sev} THEN {sev} END AS severity,
            CASE WHEN {has_sev} THEN {score} END AS severity_score,
            CASE WHEN {has_h} THEN {ofloat('duration_hours')} END AS duration_hours,
            CASE WHEN {has_h} THEN {ofloat('duration_hours')} * 60 END AS duration_minutes"""),
        "symptoms": sel("symptoms", f"""
            symptom AS primary_symptom, intensity AS severity,
            {ostrip('intensity')} AS severity_score,
            {ostrip('duration_minutes')} AS duration, 'minutes' AS duration_unit"""),
        "medication": sel("medication", f"""
            medicine AS medication_name, {ostrip('dose')} AS dosage, 'mg' AS dosage_unit,
            times_per_day AS frequency"""),
        "mood": sel("mood", f"feeling AS mood, {ostrip('rating')} AS mood_score"),
        "pain": sel("pain", f"body_part AS pain_location, {ostrip('pain_scale')} AS pain_intensity"),
        "weight": sel("weight", f"""
            {ostrip('body_weight')} AS weight,
            CASE WHEN {ostrip('body_weight')} > 50 THEN 'kg' ELSE 'lbs' END AS weight_unit,
            {ostrip('bmi')} AS bmi"""),
        "blood_pressure": sel("blood_pressure", f"{ostrip('sys')} AS systolic, {ostrip('dia')} AS diastolic"),
        "glucose": sel("glucose", f"{ostrip('blood_sugar')} AS glucose"),
        "general": sel("general", f"""
            CASE WHEN {onb('energy')} IS NOT NULL THEN {ostrip('energy')} END AS energy,
            CASE WHEN {onb('"Steps Walked"')} IS NOT NULL THEN {ostrip('"Steps Walked"')} END AS steps_walked,
            CASE WHEN {onb('"Note Text"')} IS NOT NULL AND {ostrip('"Note Text"')} IS NULL
                 THEN "Note Text" END AS note_text"""),
    }


# ---------------------------------------------------------------- moves ----

def o_moves_activities() -> str:
    return f"""SELECT {core('moves', "'fitness'", "'activity'", '"Start"', f'''
        COALESCE({onb('"Activity"')}, 'unknown') AS activity_type,
        COALESCE({onb('"Group"')}, {onb('"Activity"')}, 'unknown') AS activity_group,
        {ofloat('"Duration (s)"')} / 60 AS duration,
        {ofloat('"Distance (mi)"')} * 1609.34 AS distance,
        CASE WHEN {onb('"Steps"')} IS NOT NULL THEN {oint('"Steps"')} END AS steps,
        {ofloat('"Calories"')} AS calories''')}
    FROM {wrap(TD.moves_activities_sql(D))} a
    WHERE {onb('"Start"')} IS NOT NULL AND {onb('"Activity"')} IS NOT NULL"""


def o_moves_places() -> str:
    ll = f"({onb('\"Latitude\"')} IS NOT NULL AND {onb('\"Longitude\"')} IS NOT NULL)"
    return f"""SELECT {core('moves', "'location'", "'location'", '"Start"', f'''
        "Name" AS place_name, COALESCE({onb('"Category"')}, 'unknown') AS category,
        CASE WHEN {ll} THEN {ofloat('"Latitude"')} END AS latitude,
        CASE WHEN {ll} THEN {ofloat('"Longitude"')} END AS longitude,
        {ofloat('"Duration"')} / 60 AS visit_duration,
        CASE WHEN trim("Link") <> '' THEN "Link" END AS external_link''')}
    FROM {wrap(TD.moves_places_sql(D))} a
    WHERE {onb('"Start"')} IS NOT NULL AND {onb('"Name"')} IS NOT NULL"""


def o_moves_storyline_csv() -> str:
    is_act = f"({onb('\"Activity\"')} IS NOT NULL AND {onb('\"Group\"')} IS NOT NULL)"
    is_pl = f"({onb('\"Name\"')} IS NOT NULL AND {onb('\"Latitude\"')} IS NOT NULL)"
    return f"""SELECT {core('moves',
        f"CASE WHEN {is_act} THEN 'fitness' ELSE 'location' END",
        f"CASE WHEN {is_act} THEN 'activity' WHEN {is_pl} THEN 'location' ELSE 'storyline' END",
        '"Start"', f'''
        CASE WHEN {is_act} THEN {ofloat('"Duration"')} / 60 END AS duration,
        CASE WHEN {is_pl} AND NOT {is_act} THEN {ofloat('"Duration"')} / 60 END AS visit_duration,
        CASE WHEN {is_pl} AND NOT {is_act} THEN "Name" END AS place_name''')}
    FROM {wrap(TD.moves_storyline_csv_sql(D))} a WHERE {onb('"Start"')} IS NOT NULL"""


def o_moves_summary() -> str:
    return f"""SELECT {core('moves', "'fitness'", "'daily_summary'", '"Date"', f'''
        {oint('"Steps"')} AS steps, {ofloat('"Distance"')} * 1609.34 AS distance,
        CASE WHEN {onb('"Calories"')} IS NOT NULL THEN {ofloat('"Calories"')} END AS calories,
        {ofloat('"Duration"')} / 60 AS active_duration''')}
    FROM {wrap(TD.moves_summary_sql(D))} a WHERE {onb('"Date"')} IS NOT NULL"""


def o_moves_json_activities() -> str:
    return f"""SELECT {core('moves', "'fitness'", "'activity'", '"startTime"', f'''
        COALESCE({onb('activity')}, 'unknown') AS activity_type,
        CASE WHEN duration <> 0 THEN duration / 60 END AS duration,
        CASE WHEN distance <> 0 THEN distance END AS distance''')}
    FROM {wrap(TD.moves_json_activities_sql(D))} a"""


def o_moves_places_json() -> str:
    return f"""SELECT {core('moves', "'location'", "'location'", '"startTime"', f'''
        COALESCE({onb('place_name')}, 'Unknown') AS place_name,
        COALESCE({onb('place_type')}, 'unknown') AS category,
        lat AS latitude, lon AS longitude''')}
    FROM {wrap(TD.moves_places_json_sql(D))} a"""


def o_storyline_json() -> str:
    """Segments derived from conversations (user turns = places, others = moves)."""
    start = "to_timestamp(1420070400 + conv_id * 86400 + turn * 600)::TIMESTAMP"
    st = f"strftime({start}, '%Y-%m-%d %H:%M:%S')"
    return f"""
    SELECT 'moves_export/json/full/storyline.json' AS origin, 'moves' AS source,
           CASE WHEN role = 'user' THEN 'location' ELSE 'fitness' END AS data_type,
           CASE WHEN role = 'user' THEN 'location' ELSE 'activity' END AS sub_type,
           {st} AS ts_text, {ots(st)} AS ts,
           CASE WHEN role = 'user' THEN 'place-' || CAST(conv_id % 17 AS VARCHAR) END AS place_name,
           CASE WHEN role = 'user' THEN COALESCE(CASE WHEN turn % 3 = 0 THEN 'home' END, 'unknown') END AS category,
           CASE WHEN role = 'user' AND turn % 4 <> 1 THEN CAST(conv_id % 90 AS DOUBLE) + 0.5::DOUBLE END AS latitude,
           CASE WHEN role = 'user' AND turn % 4 <> 1 THEN CAST(turn % 180 AS DOUBLE) + 0.25::DOUBLE END AS longitude,
           CASE WHEN role <> 'user' THEN CASE WHEN length(text) % 2 = 0 THEN 'walking' ELSE 'running' END END AS activity_type,
           CASE WHEN role <> 'user' AND length(text) % 1800 <> 0 THEN CAST(length(text) % 1800 AS DOUBLE) / 60 END AS duration,
           CASE WHEN role <> 'user' AND length(text) <> 0 THEN CAST(length(text) AS DOUBLE) END AS distance
    FROM conversations"""


# ---------------------------------------------------------------- nike -----

def o_nike_orders() -> str:
    """Per order: the wristband document's summary fields."""
    return """
    SELECT l_orderkey, min(l_shipdate) AS first_ship, count(*) AS n,
           sum(l_quantity) AS qty, sum(floor(l_extendedprice)) AS price
    FROM lineitem GROUP BY l_orderkey"""


def o_nike_summary() -> str:
    ts_text = "strftime(first_ship, '%Y-%m-%d') || ' 00:00:00'"
    return f"""
    SELECT 'NikePlus-' || strftime(first_ship, '%Y-%m-%d') || '-act' || CAST(l_orderkey AS VARCHAR) || '-NoGPS.json' AS origin,
           'nike_plus' AS source, 'fitness' AS data_type, 'activity' AS sub_type,
           {ts_text} AS ts_text, {ots(ts_text)} AS ts,
           'act' || CAST(l_orderkey AS VARCHAR) AS activity_id,
           'ALL_DAY' AS activity_type,
           CASE WHEN qty * 10 <> 0 THEN CAST(qty * 10 AS DOUBLE) END AS steps,
           CASE WHEN CAST(price AS BIGINT) % 5000 <> 0 THEN CAST(CAST(price AS BIGINT) % 5000 AS DOUBLE) END AS calories,
           CASE WHEN qty <> 0 THEN qty / 8 END AS distance,
           CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(n * 100 AS DOUBLE) END AS fuel_points,
           CAST(n * 60 + CAST(qty AS BIGINT) % 60 AS DOUBLE) + 0.5::DOUBLE AS duration
    FROM ({o_nike_orders()}) g"""


def o_nike_minutes() -> str:
    base = "strftime(first_ship, '%Y-%m-%d') || ' 00:00:00'"
    types = "CASE l_orderkey % 4 WHEN 0 THEN 'fuel' WHEN 1 THEN 'steps' WHEN 2 THEN 'calories' ELSE 'distance' END"
    return f"""
    WITH lines AS (
      SELECT l_orderkey, l_linenumber, l_quantity,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) - 1 AS pos,
             min(l_shipdate) OVER (PARTITION BY l_orderkey) AS first_ship
      FROM lineitem)
    SELECT 'NikePlus-' || strftime(first_ship, '%Y-%m-%d') || '-act' || CAST(l_orderkey AS VARCHAR) || '-NoGPS.json' AS origin,
           'nike_plus' AS source, 'fitness' AS data_type, 'minute_' || {types} AS sub_type,
           {orender(f"{ots(base)} + to_minutes(CAST(pos * (l_orderkey % 2 + 1) AS BIGINT))")} AS ts_text,
           {ots(base)} + to_minutes(CAST(pos * (l_orderkey % 2 + 1) AS BIGINT)) AS ts,
           'act' || CAST(l_orderkey AS VARCHAR) AS activity_id,
           pos * (l_orderkey % 2 + 1) AS minute_offset,
           CAST(floor(l_quantity) AS DOUBLE) AS value,
           {types} AS metric_type
    FROM lines WHERE l_linenumber % 3 <> 0"""


# ---------------------------------------------------------------- apple ----

def o_xml_attrs(where: str = "TRUE") -> str:
    def a(name):
        return f"NULLIF(regexp_extract(line, ' {name}=\"([^\"]*)\"', 1), '')"
    return f"""
    SELECT origin, tag, {a('type')} AS type, replace({a('sourceName')}, '&amp;', '&') AS source_name,
           {a('sourceVersion')} AS source_version, {a('unit')} AS unit, {a('value')} AS value,
           {a('startDate')} AS start_date, {a('endDate')} AS end_date, {a('creationDate')} AS creation_date,
           {a('workoutActivityType')} AS workout_type, {a('duration')} AS duration,
           {a('durationUnit')} AS duration_unit, {a('totalDistance')} AS total_distance,
           {a('totalDistanceUnit')} AS total_distance_unit, {a('totalEnergyBurned')} AS total_energy,
           {a('totalEnergyBurnedUnit')} AS total_energy_unit
    FROM {wrap(TD.xml_lines_sql(D))} x WHERE {where}"""


def apple_type_case(col: str) -> str:
    from vitaldf.schema import APPLE_TYPES
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in APPLE_TYPES.items()) + " ELSE 'unknown' END"


def apple_unit_case(col: str) -> str:
    from vitaldf.schema import APPLE_UNITS
    return "COALESCE(CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in APPLE_UNITS.items()) + f" END, {col})"


def apple_subtype_case(col: str) -> str:
    from vitaldf.schema import APPLE_SUBTYPES
    return ("COALESCE(CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in APPLE_SUBTYPES.items())
            + f" END, lower(replace({col}, 'HKQuantityTypeIdentifier', '')))")


def apple_metric_case(col: str) -> str:
    from vitaldf.schema import APPLE_METRIC_KEYS
    return ("COALESCE(CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in APPLE_METRIC_KEYS.items())
            + " END, 'metric_value')")


def o_apple_records(where: str = "TRUE") -> str:
    conf = ("CASE WHEN contains(source_name, 'Apple Watch') OR contains(source_name, 'iPhone') THEN 0.9 "
            "WHEN contains(source_name, 'Health') THEN 0.8 ELSE 0.7 END::DOUBLE")
    ts_text = f"COALESCE({onb('start_date')}, creation_date)"
    ranged = "(end_date IS NOT NULL AND end_date <> COALESCE(start_date, ''))"
    return f"""
    SELECT origin, 'apple_health' AS source, {apple_type_case('type')} AS data_type,
           {apple_subtype_case('type')} AS sub_type, {ts_text} AS ts_text, {ots(ts_text)} AS ts,
           {apple_metric_case('type')} AS metric_name, {ofloat('value')} AS value,
           {apple_unit_case('unit')} AS unit, {conf} AS confidence,
           CASE WHEN {ranged} THEN {odur('start_date', 'end_date')} END AS duration,
           CASE WHEN {ranged} THEN {ots('end_date')} END AS end_time,
           COALESCE(source_name, 'Unknown') AS device_name
    FROM ({o_xml_attrs(where)}) x
    WHERE tag = 'Record' AND type IS NOT NULL AND {apple_type_case('type')} <> 'unknown'"""


def o_apple_workouts(where: str = "TRUE") -> str:
    return f"""
    SELECT origin, 'apple_health' AS source, 'fitness' AS data_type, 'workout' AS sub_type,
           start_date AS ts_text, {ots('start_date')} AS ts,
           COALESCE(workout_type, 'Unknown') AS workout_type,
           CASE WHEN {onb('duration')} IS NOT NULL THEN {ofloat('duration')}
                ELSE {odur('start_date', 'end_date')} END AS duration,
           CASE WHEN {onb('duration')} IS NOT NULL THEN COALESCE({onb('duration_unit')}, 'minutes')
                ELSE 'minutes' END AS duration_unit,
           CASE WHEN {onb('total_energy')} IS NOT NULL THEN {ofloat('total_energy')} END AS calories,
           CASE WHEN {onb('total_distance')} IS NOT NULL THEN {ofloat('total_distance')} END AS distance,
           {ots('end_date')} AS end_time
    FROM ({o_xml_attrs(where)}) x WHERE tag = 'Workout'"""


# ---------------------------------------------------------------- all ------

def core_parts() -> list[str]:
    """Core columns of every layout the union of sources contains."""
    cols = "origin, source, data_type, sub_type, ts_text, ts"
    parts = [o_gyro_steps(), o_gyro_vitals(), o_gyro_visits(), o_gyro_workouts(), o_gyro_sleep(),
             o_sleep_quality(), o_sleep_simple(), o_sleep_detailed(), o_sleep_generic(),
             o_habits(), *o_manual().values(),
             o_moves_activities(), o_moves_places(), o_moves_storyline_csv(), o_moves_summary(), o_moves_generic(),
             o_moves_json_activities(), o_moves_places_json(), o_storyline_json(),
             o_nike_summary(), o_nike_minutes(), o_apple_records(), o_apple_workouts()]
    return [f"SELECT {cols} FROM ({p}) p" for p in parts]


def all_core() -> str:
    """Every finalised row: core columns + ``ok`` (valid record) flag."""
    u = " UNION ALL ".join(core_parts())
    return f"""SELECT *, (ts IS NOT NULL) AS ok,
               CASE WHEN {onb('ts_text')} IS NULL THEN 'missing'
                    WHEN ts IS NULL THEN 'unparseable' END AS reason
               FROM ({u}) u"""


def o_moves_generic() -> str:
    return f"""SELECT {core('moves', "'mixed'", "'generic'", '"Day Start"')}
    FROM {wrap(TD.moves_generic_sql(D))} a WHERE {onb('"Day Start"')} IS NOT NULL"""
