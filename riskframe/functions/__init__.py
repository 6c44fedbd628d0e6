from riskframe.functions.exprs import (  # noqa: F401
    blend,
    clip_lower,
    clip_upper,
    equals_flag,
    flag,
    hard_decision,
    prefix_family,
    row_max,
    row_mean,
    row_min,
    safe_divide,
    safe_name_column,
    sentinel_to_null,
    sigmoid,
    years_from_days,
)
