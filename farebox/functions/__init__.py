"""Column expressions shared by all layers (JVM-side built-ins only, no UDFs)."""

from farebox.functions.columns import (  # noqa: F401
    average_speed_mph,
    date_key,
    duration_minutes,
    floor_round,
    hour_key,
    invalid_reason,
    safe_div,
    surrogate_key,
    trip_id,
)
