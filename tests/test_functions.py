import math
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hearthline import functions as fn
from tests.conftest import values


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("12", 12.0), (" 12 ", 12.0), ("\t12\n", 12.0), ("-1", -1.0), ("+3.5", 3.5), (".5", 0.5), ("5.", 5.0),
        ("1e3", 1000.0), ("2E-1", 0.2), ("1d", None), ("1f", None), ("on demand", None),
        ("", None), (None, None), ("1,5", None), ("0x10", None), ("1 2", None), ("nan", None),
        ("Infinity", math.inf),
    ],
)
def test_parse_number(frame, text, number):
    df = frame([(text,)], "x string")
    assert df.select(fn.to_number(df, "x")).first()[0] == number


def test_to_number_of_numeric_columns_drops_nan(frame):
    df = frame([(1, 2.5), (2, math.nan), (None, None)], "i int, d double")
    got = df.select(fn.to_number(df, "i"), fn.to_number(df, "d")).collect()
    assert [tuple(r) for r in got] == [(1.0, 2.5), (2.0, None), (None, None)]


def test_canonical_number(frame):
    df = frame([("5",), ("5.0",), ("n.c.",), (None,)], "x string")
    got = [r[0] for r in df.select(fn.canonical_number(F.col("x"))).collect()]
    assert got == ["5.0", "5.0", "n.c.", None]


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("  Rue  DE\tla\n Loi ", "rue de la loi"),
        (" A  b　", "a b"),
        ("\x1cx\x1f", "x"),
        ("   ", ""),
        ("[a]-^\\", "[a]-^\\"),
        (None, None),
    ],
)
def test_normalised(frame, text, clean):
    df = frame([(text,)], "x string")
    assert df.select(fn.normalised(F.col("x"))).first()[0] == clean


def test_trimmed_agrees_with_python(frame):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    rows = [(i, f"{s}a{s}{s}b{s}") for i, s in enumerate(spaces)]
    df = frame(rows, "i int, x string")
    got = values(df.select("i", fn.trimmed(F.col("x")), fn.collapse_spaces(F.col("x"))))
    assert got == [(i, x.strip(), f" a b ") for i, x in rows]


def test_canonical_code(frame):
    df = frame([(" 1000 ",), ("1000.0",), ("B-10",), (None,)], "x string")
    got = [r[0] for r in df.select(fn.canonical_code(F.col("x"))).collect()]
    assert got == ["1000", "1000", "B-10", None]


def test_missing_rules(frame):
    df = frame([(1, "a", -2.0), (2, "b", 3.0), (3, None, None)], "i int, s string, d double")
    got = df.select(
        "i",
        fn.keep_unless_in(F.col("s"), ["a"]),
        fn.at_least(F.col("d"), 0),
        fn.null_if(F.col("s"), "b"),
        fn.is_true(F.col("d") > 0),
    )
    assert values(got) == [
        (1, False, 0.0, "a", False),
        (2, True, 3.0, None, True),
        (3, True, None, None, False),
    ]


def test_completeness_counts_nan_as_missing(frame):
    df = frame([(1, "a", 1.0), (2, None, math.nan)], "i int, s string, d double")
    assert values(df.select("i", fn.completeness(df, ["i", "s", "d"]))) == [(1, 3), (2, 1)]
    cleaned = fn.nans_to_nulls(df)
    assert values(cleaned) == [(1, "a", 1.0), (2, None, None)]


def test_posted_at(frame):
    df = frame([("2026-07-02",), ("2026-07-02 10:11:12",), ("soon",), (None,)], "d string")
    got = [r[0] for r in df.select(fn.posted_at(df, "d")).collect()]
    assert got == [datetime(2026, 7, 2), datetime(2026, 7, 2, 10, 11, 12), None, None]
    with pytest.raises(PySparkException, match="soon"):
        df.select(fn.posted_at(df, "d", "fail")).collect()
    with pytest.raises(ValueError):
        fn.posted_at(df, "d", "ignore")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_dates_depend_on_the_text_alone(spark, frame, zone):
    texts = ["12:30", "T12:30", "2024-01-01T00:30:00+02:00", "2024-01-01 00:30:00.25Z", "2024-1-5", "2024",
             "15/03/2024", "2024-02-30", " 2024-03-01 ", "2024-03-01x", "5d"]
    df = frame([(t,) for t in texts], "d string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        plain = [r[0] for r in df.select(fn.posted_at(df, "d")).collect()]
        listed = [r[0] for r in df.select(fn.posted_at(df, "d", formats=["dd/MM/yyyy"])).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = [None, None, datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 1, 0, 30, 0, 250000), datetime(2024, 1, 5),
            None, None, None, datetime(2024, 3, 1), None, None]
    assert plain == want
    assert listed == [*want[:6], datetime(2024, 3, 15), *want[7:]]


def test_euros(frame):
    df = frame([(1234.5,), (1235.5,), (-1234567.2,), (0.4,)], "x double")
    got = [r[0] for r in df.select(fn.euros(F.col("x"))).collect()]
    assert got == ["1,234", "1,236", "-1,234,567", "0"]
