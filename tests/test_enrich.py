import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hearthline.operators import lookup_join as lj
from hearthline.operators.enrich import (
    add_commune_code,
    count_enriched,
    enrich_with_commune_stats,
)
from hearthline.plans import engineer_features, prepare_cv, prepare_training
from tests.conftest import values


@pytest.fixture
def codes(frame):
    return frame([("1000", 21.0), ("1005", 21.0), ("2000", 22.0), ("3000", 99.0)],
                 "postal_code string, nis_code double")


@pytest.fixture
def stats(frame):
    return frame(
        [(21.0, 2025.0, 10.0, 300.0, 5.0, None), (22.0, 2025.0, 7.0, 200.0, 4.0, 150.0)],
        "nis_code double, year double, house_count double, house_median double, "
        "apt_count double, apt_median double",
    )


@pytest.fixture
def homes(frame):
    return frame(
        [
            (1, " 1000 ", "house"), (2, "1005", "appartment"), (3, "2000.0", "appartment"),
            (4, "2000", None), (5, "3000", "house"), (6, "4000", "house"), (7, None, "house"),
        ],
        "id int, postal_code string, category string",
    )


def test_all_outcomes(homes, codes, stats):
    got = enrich_with_commune_stats(homes, codes, stats)
    assert got.columns == [*homes.columns, "statbel_commune_median", "statbel_transaction_count"]
    assert values(got, "id", "statbel_commune_median", "statbel_transaction_count") == [
        (1, 300.0, 10.0), (2, None, 5.0), (3, 150.0, 4.0), (4, 200.0, 7.0), (5, None, None),
        (6, None, None), (7, None, None),
    ]
    assert count_enriched(got).first().asDict() == {"matched": 3, "listings": 7}


def test_commune_code(homes, codes):
    got = add_commune_code(homes, codes)
    assert values(got, "id", "nis_code") == [
        (1, 21.0), (2, 21.0), (3, 22.0), (4, 22.0), (5, 99.0), (6, None), (7, None),
    ]


def test_repeated_keys_are_refused(homes, codes, stats):
    for twice, what in (((codes, stats.union(stats)), "commune statistics"), ((codes.union(codes), stats), "postal map")):
        with pytest.raises(PySparkException, match=what):
            enrich_with_commune_stats(homes, *twice).collect()


@pytest.fixture
def hot_keys(spark):
    """A third of the rows has one key, another third has none."""
    third = F.col("id") % 3
    key = F.when(third == 0, 7).when(third == 1, F.col("id"))
    left = spark.range(30_000, numPartitions=6).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    lookup = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return left, lookup


def test_a_large_lookup_is_shuffled_and_hot_keys_are_split(spark, hot_keys):
    left, lookup = hot_keys
    small = values(lj.lookup_join(left, lookup, "k"), "id", "v")
    forced = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in forced}
    try:
        for k, v in forced.items():
            spark.conf.set(k, v)
        joined = lj.lookup_join(left, lookup, "k")
        assert values(joined, "id", "v") == small
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_job_runs_before_the_result_is_read(spark, homes, codes, stats):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    enrich_with_commune_stats(homes, codes, stats)
    assert tracker.getJobIdsForGroup("planning") in ([], ())
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture
def fixture_tables(spark, small, listings):
    from checks import queries

    return (
        queries._clean_without_order(spark, small),
        queries._postal(spark, small),
        queries._stats(spark, small),
    )


def test_engineering_keeps_rows_in_scope(fixture_tables):
    cleaned, postal, communes = fixture_tables
    got = engineer_features(cleaned, postal, communes)
    in_scope = cleaned.filter(
        "category IS NULL OR category NOT IN ('garage', 'land', 'investment_property', 'entreprise')"
    )
    assert got.count() == in_scope.count()
    gone = {"availability", "epc", "flooding_area_type"}
    assert gone.isdisjoint(got.columns)


def test_prepared_rows_have_unique_keys_and_an_exact_split(fixture_tables):
    ready = prepare_training(*fixture_tables)
    n = ready.count()
    assert ready.select("row_key").distinct().count() == n
    assert ready.filter("split = 'test'").count() == -(-n // 5)
    whole = prepare_cv(*fixture_tables)
    assert whole.count() == n
    assert whole.exceptAll(ready.drop("split")).isEmpty()
