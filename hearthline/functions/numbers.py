"""Numbers out of text; what does not parse becomes missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions.missing import nan_to_null

# Spark's cast also takes Java suffixes such as '1d'; this pattern does not.
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*([e][+-]?\d+)?|\.\d+([e][+-]?\d+)?|inf|infinity)\s*$"


def parse_number(c: Column) -> Column:
    """A text column as double, null where the text is not a number."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def parse_number_sql(name: str) -> str:
    """``parse_number`` of a text column as SQL text."""
    return f"CASE WHEN `{name}` RLIKE r'{_NUMBER}' THEN TRY_CAST(`{name}` AS DOUBLE) END"


def to_number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double, whatever its stored type."""
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return parse_number(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(c.cast("double"))
    return c.cast("double")


def number_sql(name: str) -> str:
    """``to_number`` as SQL text, for stages that are kept as SQL; the type is looked up there."""
    c = f"`{name}`"
    text = f"typeof({c}) = 'string' AND NOT CAST({c} AS STRING) RLIKE r'{_NUMBER}'"
    return f"CASE WHEN {text} THEN NULL ELSE nanvl(TRY_CAST({c} AS DOUBLE), NULL) END"


def canonical_number(c: Column) -> Column:
    """Numeric text in one spelling (``'5'`` and ``'5.0'`` agree); other text as it is."""
    return F.coalesce(parse_number(c).cast("string"), c)


def euros(c: Column) -> Column:
    """Whole euros with thousands separators."""
    return F.format_number(c, 0)
