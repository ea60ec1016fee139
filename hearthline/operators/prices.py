"""Rows without a usable price leave the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions import is_true, to_number
from hearthline.operators.quantiles import approximate_quantiles, exact_quantiles
from hearthline.settings import LIMITS, Limits


def price_cap(
    df: DataFrame, column: str = "price", limits: Limits = LIMITS, approx: bool = False
) -> float | None:
    """The price quantile over all prices present, also those that other rules reject.

    With ``approx`` one pass gives a price whose rank is off by at most a ten-thousandth of the rows.
    """
    if approx:
        return approximate_quantiles(df, [column], limits.price_quantile)[column]
    return exact_quantiles(df, [column], limits.price_quantile)[column]


def price_findings(
    df: DataFrame, cap: float | None, column: str = "price", limits: Limits = LIMITS
) -> dict[str, Column]:
    price = to_number(df, column)
    return {
        "price_missing": price.isNull(),
        "price_not_positive": is_true(price <= 0),
        "price_below_min": is_true((price > 0) & (price < limits.min_price)),
        "price_above_cap": is_true(price > F.lit(cap).cast("double")),
    }


def valid_price(
    df: DataFrame, cap: float | None, column: str = "price", limits: Limits = LIMITS
) -> Column:
    """Whether a row keeps its place in ``remove_invalid_price``."""
    if cap is None:
        return F.lit(False)
    price = to_number(df, column)
    return is_true((price > 0) & (price >= float(limits.min_price)) & (price <= cap))


def remove_invalid_price(
    df: DataFrame,
    column: str = "price",
    limits: Limits = LIMITS,
    cap: float | None = None,
    approx: bool = False,
) -> DataFrame:
    """Keep prices from the minimum to the cap, both inclusive; the column becomes a number.

    Finding the cap reads the price column of ``df``, so pass a stored table. The cap enters
    the filter as a plain value, which the scan can use.
    """
    if cap is None:
        cap = price_cap(df, column, limits, approx)
    if not isinstance(df.schema[column].dataType, T.NumericType):
        df = df.withColumn(column, to_number(df, column))
    price = F.col(f"`{column}`")
    if cap is None:
        df = df.filter(F.lit(False))
    else:
        # On the stored column; NaN compares as the largest number and goes with the cap.
        df = df.filter((price > 0) & (price >= float(limits.min_price)) & (price <= cap))
    return df.withColumn(column, price.cast("double"))
