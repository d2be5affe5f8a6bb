"""Column expressions used by every job: built-in functions only, no UDFs."""

from vitaldf.functions.lookups import (  # noqa: F401
    base_name, classify_file_manual, classify_file_moves, confidence_service,
    confidence_source, datatype_apple, file_name, gyro_data_type, gyro_sub_type,
    habit_categorize, keyword_class, literal_map, lookup, severity_map,
    severity_score, subtype_apple, unit_infer_sleep, unit_map_apple, weight_unit,
)
from vitaldf.functions.metrics import (  # noqa: F401
    attr, barrier, location, m, metric, metric_confidence, metric_map, metric_unit,
    metric_value, metric_when, null_location, null_metric, string_map, time_of,
)
from vitaldf.functions.numbers import (  # noqa: F401
    duration_hm_minutes, duration_hms_minutes, float_prefix, int_prefix,
    or_default, pct_parse, strip_parse,
)
from vitaldf.functions.text import (  # noqa: F401
    coalesce_nonblank, col_or_null, first_matching_column, first_present_column,
    json_raw, name_slug, slug, xml_attributes, xml_unescape,
)
from vitaldf.functions.timestamps import (  # noqa: F401
    blank_to_null, date_normalize, date_only, date_render, duration_minutes, may_be_of_days,
    ts_add_minutes, ts_is_valid_format, ts_normalize, ts_now, ts_parse, ts_render,
)
