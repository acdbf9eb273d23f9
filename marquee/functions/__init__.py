"""Column expressions; all JVM-side, safe under ANSI mode."""

from marquee.functions.scalars import (
    age_years,
    bool_to_int,
    bucketize,
    date_or_null,
    date_parts,
    differs_flag,
    english_list,
    hash_bucket,
    int_to_bool,
    not_in_flag,
    prefixed,
    text_length,
)

__all__ = [
    "age_years",
    "bool_to_int",
    "bucketize",
    "date_or_null",
    "date_parts",
    "differs_flag",
    "english_list",
    "hash_bucket",
    "int_to_bool",
    "not_in_flag",
    "prefixed",
    "text_length",
]
