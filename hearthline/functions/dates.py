"""Posting dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A full date, alone or with a time, perhaps with a zone; a time alone is no date.
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)?)?$"
_ZONE = r"(?<=:\d{2}|[.,]\d{1,9})\s*(Z|[+-]\d{2}(:?\d{2})?)$"


def parse_date(text: Column, formats: Sequence[str] = ()) -> Column:
    """Text as a time without a zone, null where it is no date.

    ISO dates are read always, then the given Spark patterns in turn, such as ``dd/MM/yyyy``. A zone
    in the text is left out and the clock time written there is kept, so the result depends neither on
    the session's zone nor on today's date.
    """
    plain = F.regexp_replace(F.trim(text), _ZONE, "")
    iso = F.when(plain.rlike(_ISO), F.regexp_replace(plain, ",", ".").try_cast("timestamp_ntz"))
    others = [
        F.try_to_timestamp(F.trim(text), F.lit(f)).cast("timestamp_ntz") for f in formats
    ]
    return F.coalesce(iso, *others)


def posted_at(
    df: DataFrame, name: str, on_bad_date: str = "null", formats: Sequence[str] = ()
) -> Column:
    """Column ``name`` as a time; a bad text is null, or an error with ``"fail"``."""
    if on_bad_date not in ("null", "fail"):
        raise ValueError(f"on_bad_date must be 'null' or 'fail', not {on_bad_date!r}")
    c = F.col(f"`{name}`")
    if not isinstance(df.schema[name].dataType, T.StringType):
        return c
    parsed = parse_date(c, formats)
    if on_bad_date == "null":
        return parsed
    # Explicit, so that bad dates fail whether or not ANSI mode is on.
    bad = c.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"{name} is not a date: "), c))).otherwise(
        parsed
    )
