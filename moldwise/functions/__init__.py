"""Column expressions (scalar functions) used across operators."""

from moldwise.functions.columns import (  # noqa: F401
    COUNTER_VARIABLES,
    SPECIAL_VARIABLES,
    ZERO_VARIANCE_VARIABLES,
    classify_names,
    classify_variable,
    clean_column_name,
    date_key,
    duration_seconds,
    machine_key,
    machine_key_from_path,
    parse_date,
    parse_date_dayfirst,
    production_core,
    risk_status,
    sensor_core,
    to_number,
)
