"""Self-tracked health CSV files; the health type comes from the file name.

The type is a row-level value (file name) while the fields are header-level,
so the fields are chosen at plan time and the per-type logic is a `when`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaldf import functions as V
from vitaldf.operators.records import header_cols, pre_record, with_occurrence, with_raw_json
from vitaldf.schema import MANUAL_DATE_FIELDS, MANUAL_FIELDS
from vitaldf.sources.sleep import fields_to_metrics

SOURCE = "manual_health"


def normalize(raw: DataFrame) -> DataFrame:
    cols = header_cols(raw)
    df = with_raw_json(with_occurrence(raw), cols)
    date_f = V.first_present_column(cols, MANUAL_DATE_FIELDS)
    htype = V.classify_file_manual(F.col("origin"))
    if date_f is None:
        return df.limit(0).select(*pre_record(SOURCE, "health", htype, F.lit(None)))
    df = df.filter(V.blank_to_null(F.col(f"`{date_f}`")).isNotNull())

    def field(kind):
        return V.first_present_column(cols, MANUAL_FIELDS[kind])

    def c(name):
        return V.col_or_null(cols, name)

    def is_(t):
        return htype == t

    metrics, attrs = {}, {}

    # migraine: severity letter/word, duration in hours
    sev_raw = V.blank_to_null(c("severity"))
    sev_word = V.severity_map(sev_raw)
    hours = V.float_prefix(c("duration_hours"))
    has_hours = V.blank_to_null(c("duration_hours")).isNotNull()
    mig = is_("migraine")
    metrics["severity_score"] = V.metric_when(mig & sev_raw.isNotNull(),
                                              V.severity_score(sev_word), "scale_1_5", 1.0)
    metrics["duration"] = V.metric_when(mig & has_hours, hours, "hours", 1.0)
    metrics["duration_minutes"] = V.metric_when(mig & has_hours, hours * 60, "minutes", 1.0)
    attrs["condition"] = F.when(mig, F.lit("migraine"))
    attrs["severity"] = F.when(mig, sev_word)
    attrs["symptom_type"] = F.when(mig, F.lit("headache")).when(is_("pain"), F.lit("pain"))
    attrs["impact_level"] = F.when(mig, sev_word)

    # symptoms
    sym = is_("symptoms")
    sym_f, sev_f, dur_f = field("symptom"), field("symptom_severity"), field("symptom_duration")
    symptoms = F.when(sym, F.array(c(sym_f))) if sym_f else None
    if sym_f:
        attrs["primary_symptom"] = F.when(sym, c(sym_f))
    if sev_f:
        attrs["severity"] = F.when(mig, sev_word).when(sym, c(sev_f))
        sv = V.strip_parse(c(sev_f))
        metrics["severity_score"] = (F.when(mig & sev_raw.isNotNull(),
                                            V.metric(V.severity_score(sev_word), "scale_1_5", 1.0))
                                     .when(sym & sv.isNotNull(), V.metric(sv, "scale", 0.9)))
    if dur_f:
        dv = V.strip_parse(c(dur_f))
        unit = "hours" if "hour" in dur_f else "minutes"
        metrics["duration"] = (F.when(mig & has_hours, V.metric(hours, "hours", 1.0))
                               .when(sym & dv.isNotNull(), V.metric(dv, unit, 0.9)))

    # medication
    med = is_("medication")
    med_f, dose_f, freq_f = field("medication"), field("dosage"), field("frequency")
    if med_f:
        attrs["medication_name"] = F.when(med, c(med_f))
    if dose_f:
        dv = V.strip_parse(c(dose_f))
        metrics["dosage"] = V.metric_when(med & dv.isNotNull(), dv,
                                          "ml" if "ml" in dose_f else "mg", 1.0)
    if freq_f:
        attrs["frequency"] = F.when(med, c(freq_f))
    attrs["medication_taken"] = F.when(med, F.lit("true"))

    # mood
    mood = is_("mood")
    mood_f, score_f = field("mood"), field("mood_score")
    if mood_f:
        attrs["mood"] = F.when(mood, c(mood_f))
    if score_f:
        sv = V.strip_parse(c(score_f))
        metrics["mood_score"] = V.metric_when(mood & sv.isNotNull(), sv, "scale", 0.9)

    # pain
    pain = is_("pain")
    loc_f, int_f = field("pain_location"), field("pain_intensity")
    if loc_f:
        attrs["pain_location"] = F.when(pain, c(loc_f))
    if int_f:
        iv = V.strip_parse(c(int_f))
        metrics["pain_intensity"] = V.metric_when(pain & iv.isNotNull(), iv, "scale_1_10", 0.9)

    # weight
    wt = is_("weight")
    w_f, b_f = field("weight"), field("bmi")
    if w_f:
        wv = V.strip_parse(c(w_f))
        metrics["weight"] = V.metric_when(wt & wv.isNotNull(), wv, V.weight_unit(wv), 0.9)
    if b_f:
        bv = V.strip_parse(c(b_f))
        metrics["bmi"] = V.metric_when(wt & bv.isNotNull(), bv, "kg/m²", 0.9)

    # blood pressure (either side may be missing)
    bp = is_("blood_pressure")
    for side in ("systolic", "diastolic"):
        f = field(side)
        if f:
            v = V.strip_parse(c(f))
            metrics[f"bp_{side}"] = V.metric_when(bp & v.isNotNull(), v, "mmHg", 0.9)

    # glucose
    g_f = field("glucose")
    if g_f:
        gv = V.strip_parse(c(g_f))
        metrics["glucose"] = V.metric_when(is_("glucose") & gv.isNotNull(), gv, "mg/dL", 0.9)

    # general: every other non-blank field, numeric -> metric, text -> attribute
    gen = is_("general")
    for name in cols:
        if name == date_f:
            continue
        key = V.slug(name)
        v = V.strip_parse(c(name))
        present = V.blank_to_null(c(name)).isNotNull()
        gm = V.metric_when(gen & present & v.isNotNull(), v, "units", 0.7)
        metrics[key] = gm if key not in metrics else F.coalesce(metrics[key], gm)
        ga = F.when(gen & present & v.isNull(), c(name))
        attrs[key] = ga if key not in attrs else F.coalesce(attrs[key], ga)

    return df.select(*pre_record(SOURCE, "health", htype, c(date_f), metrics, attrs,
                                 symptoms=symptoms))


__all__ = ["normalize", "fields_to_metrics"]
