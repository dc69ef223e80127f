"""Scalar building blocks: geodesy, domain scalars, JSON codec."""

from .codec import decode, encode, is_json_object, json_field, payload_text
from .geo import EARTH_RADIUS_M, haversine_m, in_box, unit_xyz
from .scalar import (advisory_level, advisory_text, aqi_from_pm25, bucket_label, clamp,
                     epoch_micros, epoch_seconds, fixed, fixed_avg, fixed_sum, iso_ms, parse_iso_ts,
                     py_round, round_half_even)

__all__ = [
    "decode", "encode", "is_json_object", "json_field", "payload_text",
    "EARTH_RADIUS_M", "haversine_m", "in_box", "unit_xyz",
    "advisory_level", "advisory_text", "aqi_from_pm25", "bucket_label", "clamp",
    "epoch_micros", "epoch_seconds", "fixed", "fixed_avg", "fixed_sum", "iso_ms", "parse_iso_ts",
    "py_round", "round_half_even",
]
