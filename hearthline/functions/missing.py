"""Missing-value rules: null is the only missing value, and no filter loses rows by accident."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def nans_to_nulls(df: DataFrame) -> DataFrame:
    """Every floating column with null in place of NaN."""
    floating = [
        f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    cells = {c: F.expr(f"CASE WHEN NOT isnan(`{c}`) THEN `{c}` END") for c in floating}
    return df.withColumns(cells) if cells else df


def null_if(c: Column, value) -> Column:
    return F.when(~c.eqNullSafe(F.lit(value)), c)


def is_true(predicate: Column) -> Column:
    """A comparison with a missing value counts as false."""
    return F.coalesce(predicate, F.lit(False))


def keep_unless_in(c: Column, values: Iterable) -> Column:
    """True unless ``c`` is one of ``values``; a missing value is kept."""
    return c.isNull() | ~c.isin(list(values))


def at_least(c: Column, low) -> Column:
    """Raise small values to ``low`` and leave missing ones missing."""
    return F.when(c < low, F.lit(low).cast("double")).otherwise(c)


def present_sql(df: DataFrame, name: str) -> str:
    """Whether a cell holds a value, as SQL text; NaN in a floating column is missing too."""
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return f"(`{name}` IS NOT NULL AND NOT isnan(`{name}`))" if floating else f"(`{name}` IS NOT NULL)"


def present(df: DataFrame, name: str) -> Column:
    return F.expr(present_sql(df, name))


def completeness(df: DataFrame, names: Iterable[str]) -> Column:
    """How many of the named cells hold a value.

    One SQL text: a wide table has hundreds of cells, and a call to the JVM for each part of each takes
    longer than small tables take to read.
    """
    return F.expr(" + ".join(["0", *(f"CAST({present_sql(df, n)} AS INT)" for n in names)]))
