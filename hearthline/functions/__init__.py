"""Column expressions; all of them stay on the JVM side."""

from hearthline.functions.dates import parse_date, posted_at
from hearthline.functions.missing import (
    at_least,
    completeness,
    is_true,
    keep_unless_in,
    nan_to_null,
    nans_to_nulls,
    null_if,
    present,
)
from hearthline.functions.numbers import (
    canonical_number,
    euros,
    number_sql,
    parse_number,
    parse_number_sql,
    to_number,
)
from hearthline.functions.text import canonical_code, collapse_spaces, normalised, trimmed

__all__ = [
    "at_least", "canonical_code", "canonical_number", "collapse_spaces", "completeness", "euros",
    "is_true", "keep_unless_in", "nan_to_null", "nans_to_nulls", "normalised", "null_if", "number_sql", "parse_date",
    "parse_number", "parse_number_sql",
    "posted_at", "present", "to_number", "trimmed",
]
