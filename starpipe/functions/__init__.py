"""Column expressions used across the pipeline (all JVM-side built-ins)."""

from starpipe.functions.scalar import (  # noqa: F401
    date_key,
    duration_minutes,
    safe_cast,
    valid_date,
)
