"""Column functions."""

from veloframe.functions.scalar import (
    blank_to_null,
    fingerprint,
    haversine_m,
    label_from,
    minutes_seconds,
    one_of,
    per,
    safe_size,
    strip_markup,
)

__all__ = ["blank_to_null", "fingerprint", "haversine_m", "label_from", "minutes_seconds", "one_of", "per", "safe_size", "strip_markup"]
