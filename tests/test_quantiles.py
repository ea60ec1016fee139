import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearthline.operators import quantiles
from hearthline.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.99, 1.0])
@pytest.mark.parametrize("at_once", [20, 1_000_000])
def test_against_numpy(frame, q, at_once):
    rng = random.Random(5)
    rows = [
        (
            rng.gauss(0, 1),
            float(rng.choice([1, 2, 2, 2, 3, 100])),
            math.exp(rng.gauss(0, 6)),
            7.0,
            rng.random() if i % 3 else None,
        )
        for i in range(4000)
    ]
    names = ["a", "b", "c", "d", "e"]
    df = frame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = exact_quantiles(df, names, q, ranked_at_once=at_once)
    for i, n in enumerate(names):
        want = np.quantile([r[i] for r in rows if r[i] is not None], q)
        assert got[n] == pytest.approx(want, rel=1e-12), n


@pytest.mark.parametrize("q", [0.0, 0.5, 0.99])
def test_an_approximate_quantile_keeps_its_rank_error(frame, q):
    rng = random.Random(7)
    values = sorted(rng.choice([rng.gauss(0, 1), 3.0]) for _ in range(5000))
    df = frame([(v, None) for v in values] + [(None, None)], "x double, y double").repartition(6)
    got = quantiles.approximate_quantiles(df, ["x", "y"], q, accuracy=200)
    assert got["y"] is None and got["x"] in values
    below, upto = sum(v < got["x"] for v in values), sum(v <= got["x"] for v in values)
    assert below <= q * 5000 + 26 and upto >= q * 5000 - 26


def test_narrowing_ranks_few_rows(spark, monkeypatch):
    ranked = []
    original = quantiles._ranked

    def watch(numbers, brackets, at):
        ranked.append({n: b.inside for n, b in brackets.items()})
        return original(numbers, brackets, at)

    monkeypatch.setattr(quantiles, "_ranked", watch)
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_000).cast("double").alias("x"))
    assert exact_quantiles(df, ["x"], 0.99, ranked_at_once=500)["x"] == pytest.approx(98999.01)
    assert ranked[0]["x"] <= 500


def test_one_value_holds_a_third_of_the_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(15_000)).otherwise(F.col("id")).alias("x")
    )
    want = np.quantile([15_000 if i % 3 == 0 else i for i in range(30_000)], [0.5, 0.99])
    assert exact_quantiles(df, ["x"], 0.5, ranked_at_once=100)["x"] == want[0]
    assert exact_quantiles(df, ["x"], 0.99, ranked_at_once=100)["x"] == pytest.approx(want[1])


def test_missing_text_and_nan(frame):
    df = frame(
        [("1", math.nan, None), ("x", 5.0, None), ("3", None, None)],
        "s string, d double, n double",
    )
    assert exact_quantiles(df, ["s", "d", "n"], 0.5) == {"s": 2.0, "d": 5.0, "n": None}
    assert exact_quantiles(df, [], 0.5) == {}
    assert exact_quantiles(df.filter("false"), ["d"], 0.5) == {"d": None}


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=60),
    st.floats(0, 1),
)
def test_any_values(spark, data, q):
    df = spark.createDataFrame([(x,) for x in data], "x double")
    got = exact_quantiles(df, ["x"], q, ranked_at_once=5)["x"]
    assert got == pytest.approx(float(np.quantile(data, q)), rel=1e-9, abs=1e-6)
