"""Column builders."""

from logvigil.functions.attack import (
    ATTACK_SIGNATURES,
    attack_type,
    contains_any,
    first_match,
    path_sample,
)
from logvigil.functions.once import with_value
from logvigil.functions.time import date_key, hour_bucket, parse_timestamp

__all__ = [
    "ATTACK_SIGNATURES",
    "attack_type",
    "contains_any",
    "date_key",
    "first_match",
    "hour_bucket",
    "parse_timestamp",
    "path_sample",
    "with_value",
]
