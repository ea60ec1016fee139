import pytest
from pyspark.errors import PySparkException

from hearthline import settings as S
from hearthline.operators import columns, features
from hearthline.plans import clean
from tests.conftest import values


def test_availability(frame):
    df = frame(
        [(1, " Immediately "), (2, "On delivery"), (3, None), (4, "IMMEDIATELY"), (5, "")],
        "id int, availability string",
    )
    got = features.availability_flag(df)
    assert got.columns == ["id", "available_immediately"]
    assert values(got) == [(1, 1), (2, 0), (3, None), (4, 1), (5, 0)]


def test_category(frame):
    names = ["house", "garage", None, "student_house", "land", "entreprise", "investment_property"]
    df = frame(list(enumerate(names)), "id int, category string")
    assert values(features.category_scope(df)) == [(0, "house"), (2, None), (3, "appartment")]


def test_epc(frame):
    labels = [*S.EPC_QUALITY, " WalloniaTripleA ", "flandersb", "FlandersG", None]
    df = frame(list(enumerate(labels)), "id int, epc string")
    got = dict(values(features.epc_quality(df)))
    assert len(S.EPC_QUALITY) == 23
    for i, label in enumerate(labels[:23]):
        assert got[i] == S.EPC_QUALITY[label]
    assert [got[i] for i in range(23, 27)] == ["excellent", None, None, None]


def test_flooding(frame):
    df = frame(
        [(1, " (Information   not available) "), (2, " No  Flooding area"), (3, None)],
        "id int, flooding_area_type string",
    )
    got = features.flooding_area(df)
    assert got.columns == ["id", "flooding_area_clean"]
    assert values(got) == [(1, None), (2, "no flooding area"), (3, None)]


def test_parking(frame):
    df = frame(
        [(1, "0", 0.0), (2, "2", 3.0), (3, "-1", None), (4, "n.c.", 0.5), (5, None, -0.0)],
        "id int, indoor_parking string, outdoor_parking double",
    )
    assert values(features.parking_flags(df)) == [
        (1, 0, 0), (2, 1, 1), (3, 1, None), (4, None, 1), (5, None, 0),
    ]


def test_building_state(frame):
    states = ["To be renovated", "To demolish", "Normal", "to demolish", None]
    df = frame(list(enumerate(states)), "id int, building_state string")
    assert values(features.building_state(df)) == [
        (0, "To renovate"), (1, "To restore"), (2, "Normal"), (3, "to demolish"), (4, None),
    ]


def test_property_age(frame):
    df = frame(
        [(1, 2026, "2000"), (2, 2026, "2030"), (3, None, "2000"), (4, 2026, "old"), (5, 2026, None)],
        "id int, post_year int, build_year string",
    )
    assert values(features.property_age(df), "id", "property_age") == [
        (1, 26.0), (2, 0.0), (3, None), (4, None), (5, None),
    ]


def test_clean(frame):
    df = frame(
        [(1, "x", 5, "2026-07-02"), (2, "y", 6, None)],
        "property_id int, street string, bedrooms int, date_posted string",
    )
    got = clean(df)
    assert got.columns == ["bedrooms", "post_year", "post_month"]
    assert values(got) == [(5, 2026, 7), (6, None, None)]
    assert len(S.DROPPED_COLUMNS) == 79 == len(set(S.DROPPED_COLUMNS))


def test_clean_fails_on_a_bad_date_unless_told_not_to(frame):
    df = frame([(1, "tomorrow")], "bedrooms int, date_posted string")
    with pytest.raises(PySparkException, match="tomorrow"):
        clean(df).collect()
    assert values(clean(df, on_bad_date="null")) == [(1, None, None)]


def test_cleaning_reads_only_what_it_keeps(spark, listings):
    plan = clean(listings)._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):]
    assert "street" not in schema and "property_id" not in schema
    assert "Exchange" not in plan


def test_target_and_features(frame):
    target, inputs = columns.target_and_features(frame([(1, 2.0)], "x int, price double"))
    assert target.columns == ["price"] and inputs.columns == ["x"]


def test_feature_groups_have_74_columns():
    names = [
        *S.NUMERIC_FEATURES, *S.FLAGS_MISSING_AS_ZERO, *S.FLAGS_MISSING_AS_UNKNOWN,
        *S.NOMINAL_FEATURES, *S.TARGET_ENCODED_FEATURES, *S.ORDINAL_FEATURES,
    ]
    assert len(names) == 74 == len(set(names))
