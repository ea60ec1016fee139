"""Clean listings to model-ready listings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hearthline import settings as S
from hearthline.operators.enrich import enrich_with_commune_stats
from hearthline.operators.features import (
    availability_flag,
    building_state,
    category_scope,
    epc_quality,
    flooding_area,
    parking_flags,
    property_age,
)
from hearthline.operators.split import content_key, split_train_test
from hearthline.sources.stages import stage

ROW_KEY = "row_key"


def engineer_features(
    df: DataFrame, postal_map: DataFrame, commune_stats: DataFrame
) -> DataFrame:
    """All feature steps in order; the commune join sees the relabelled categories."""
    df = availability_flag(df)
    df = category_scope(df)
    df = epc_quality(df)
    df = flooding_area(df)
    df = parking_flags(df)
    df = building_state(df)
    df = enrich_with_commune_stats(df, postal_map, commune_stats)
    return property_age(df)


def prepare_cv(df: DataFrame, postal_map: DataFrame, commune_stats: DataFrame) -> DataFrame:
    """Distinct, engineered listings with a row key, not split.

    The key is a digest of the clean row, unique because exact duplicates are gone.
    """
    distinct = df.dropDuplicates()  # not a stored table, so it is read once
    keyed = distinct.withColumn(ROW_KEY, content_key(distinct))
    return engineer_features(keyed, postal_map, commune_stats)


def prepare_training(
    df: DataFrame,
    postal_map: DataFrame,
    commune_stats: DataFrame,
    test_share: float = S.TEST_SHARE,
    seed: int = S.SEED,
) -> DataFrame:
    """``prepare_cv`` with a ``split`` column, "train" or "test".

    Stored before the split, because finding the cut and fitting models read it many times.
    """
    ready = stage(prepare_cv(df, postal_map, commune_stats), "prepared")
    return split_train_test(ready, ROW_KEY, test_share, seed)
