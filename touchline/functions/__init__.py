from touchline.functions.expressions import (  # noqa: F401
    all_not_null,
    canonical_pair_columns,
    epoch_ms_to_ts,
    escape_like,
    form_points,
    form_result,
    match_result,
    normalize_status,
    parse_utc,
    topic_kind,
)
