"""Listing columns turned into model features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline import settings as S
from hearthline.functions import (
    at_least,
    keep_unless_in,
    normalised,
    null_if,
    to_number,
    trimmed,
)


def availability_flag(df: DataFrame) -> DataFrame:
    """``available_immediately``: 1, 0, or missing with the availability."""
    text = F.lower(trimmed(F.col("availability").cast("string")))
    flag = F.when(text == S.AVAILABLE_NOW, 1).when(text.isNotNull(), 0)
    return df.withColumn("available_immediately", flag).drop("availability")


def category_scope(df: DataFrame) -> DataFrame:
    """Leave out the categories not priced here; student housing counts as apartments."""
    kept = df.filter(keep_unless_in(F.col("category"), S.OUT_OF_SCOPE_CATEGORIES))
    return kept.replace(S.CATEGORY_RELABEL, subset=["category"])


def epc_quality(df: DataFrame) -> DataFrame:
    """One energy quality scale for the labels of three regions."""
    label = trimmed(F.col("epc").cast("string"))
    scale = F.create_map(*[F.lit(x) for pair in S.EPC_QUALITY.items() for x in pair])
    return df.withColumn("epc_quality", F.try_element_at(scale, label)).drop("epc")


def flooding_area(df: DataFrame) -> DataFrame:
    """Normalised flooding area; "not available" is missing."""
    area = normalised(F.col("flooding_area_type").cast("string"))
    return df.withColumn("flooding_area_clean", null_if(area, S.FLOODING_NOT_KNOWN)).drop(
        "flooding_area_type"
    )


def parking_flags(
    df: DataFrame, columns: Sequence[str] = ("indoor_parking", "outdoor_parking")
) -> DataFrame:
    """Parking counts to 0 or 1, in place; any number but 0 is 1."""

    def flag(name: str):
        count = to_number(df, name)
        return F.when(count == 0, 0).when(count.isNotNull(), 1)

    return df.withColumns({c: flag(c) for c in columns})


def building_state(df: DataFrame) -> DataFrame:
    """Merge the rare building states into their neighbours."""
    return df.replace(S.BUILDING_STATE_RELABEL, subset=["building_state"])


def property_age(df: DataFrame) -> DataFrame:
    """Years from construction to posting, 0 for buildings still to come."""
    years = to_number(df, "post_year") - to_number(df, "build_year")
    return df.withColumn("property_age", at_least(years, 0))
