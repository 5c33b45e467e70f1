from trilayer.functions.draws import hash_pick, hash_uniform
from trilayer.functions.flags import parse_bool
from trilayer.functions.numbers import (
    normalize_number,
    safe_double,
    safe_int,
    safe_ratio,
    zero_fill,
)

__all__ = [
    "hash_pick",
    "hash_uniform",
    "normalize_number",
    "parse_bool",
    "safe_double",
    "safe_int",
    "safe_ratio",
    "zero_fill",
]
