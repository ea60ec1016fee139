import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES
from hearthline import settings as S
from hearthline.ml.training import FeatureGroups

FITTED = {"linear_predict", "rf_predict", "gbt_predict", "gbt_metrics"}


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_both_engines_agree(spark, duck, small, name):
    assert differences(spark, duck, small, name) is None


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == FITTED
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert "price" in df.columns and df.count() > 0


def test_the_fixture_has_every_column_and_label(listings):
    assert set(S.DROPPED_COLUMNS) <= set(listings.columns)
    made = {"post_year", "post_month", "statbel_commune_median", "statbel_transaction_count", "property_age",
            "available_immediately", "flooding_area_clean", "epc_quality"}
    assert set(FeatureGroups().columns()) - made <= set(listings.columns)
    labels = {r[0].strip() for r in listings.select("epc").distinct().collect() if r[0]}
    assert set(S.EPC_QUALITY) < labels
