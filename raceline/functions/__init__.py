"""Column expressions shared by the models (all JVM-side built-ins)."""

from raceline.functions.columns import (  # noqa: F401
    add_seconds,
    clean_gap,
    concat_ignore_nulls,
    epoch_seconds_between,
    nan_to_null,
    round_half_up,
    strip_lapped,
)
