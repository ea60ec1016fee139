"""Exact quantiles of many columns that never gather a whole column in one task.

Spark's ``percentile`` keeps every distinct value of a column in one place. Here the values between a
column's smallest and largest are counted in equal steps; the step that holds the wanted rank is counted
in steps again, until it holds one value or few rows; only those are ranked. Counts are combined before
they are shuffled and spread over tasks by step, so neither the number of rows nor of tasks makes one
task large.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions import to_number

_STEPS = 512
_LARGEST = 1.7976931348623157e308
RANKED_AT_ONCE = 10_000


@dataclass(frozen=True)
class _Bracket:
    """``inside`` values from ``low`` to ``high``, both inclusive, and ``below`` smaller ones.

    ``above`` is the smallest value beyond, where the upper of the two wanted ranks lies there.
    """

    below: int
    inside: int
    low: float
    high: float
    above: float | None = None

    def holds(self, c: Column) -> Column:
        return c.between(self.low, self.high)


def exact_quantiles(
    df: DataFrame, columns: Iterable[str], q: float, ranked_at_once: int = RANKED_AT_ONCE
) -> dict[str, float | None]:
    """The ``q`` quantile of each column, linear between neighbours; ``None`` if all missing.

    Reads ``df`` two times, plus once per narrowing by five hundred, so pass a stored table and not a
    long plan. The rows left to rank, ``ranked_at_once`` per column, say how far the search narrows and
    not what it finds.
    """
    names = list(columns)
    if not names:
        return {}
    numbers = df.select(*[to_number(df, n).alias(n) for n in names])
    ends = numbers.agg(
        *[
            f(f"`{n}`").alias(f"{n}|{k}")
            for n in names
            for k, f in (("rows", F.count), ("low", F.min), ("high", F.max))
        ]
    ).first()
    brackets = {
        n: _Bracket(0, ends[f"{n}|rows"], ends[f"{n}|low"], ends[f"{n}|high"])
        for n in names
        if ends[f"{n}|rows"]
    }
    if not brackets:
        return dict.fromkeys(names)
    at = {n: q * (b.inside - 1) for n, b in brackets.items()}
    while wide := {n: b for n, b in brackets.items() if b.inside > ranked_at_once and b.low < b.high}:
        brackets |= _narrow(numbers, wide, at)
    found = _ranked(numbers, brackets, at)
    return {n: found.get(n) for n in names}


def approximate_quantiles(
    df: DataFrame, columns: Iterable[str], q: float, accuracy: int = 10_000
) -> dict[str, float | None]:
    """A value near the ``q`` quantile of each column, in one pass; ``None`` if all are missing.

    Tasks summarise their rows in sketches of bounded size, which are merged. The value is one of the
    column's, and its rank is off by at most ``1 / accuracy`` of the rows.
    """
    names = list(columns)
    if not names:
        return {}
    found = df.agg(*[F.percentile_approx(to_number(df, n), q, accuracy).alias(n) for n in names]).first()
    return {n: found[n] for n in names}


def _long(numbers: DataFrame, brackets: dict[str, _Bracket]) -> DataFrame:
    """One (feature, value) row per value that lies in its feature's bracket."""
    cells = [
        F.when(b.holds(F.col(f"`{n}`")), F.col(f"`{n}`")).alias(n) for n, b in brackets.items()
    ]
    return numbers.select(*cells).unpivot([], list(brackets), "feature", "value").dropna()


def _step(value: Column, low: Column, high: Column) -> Column:
    """Which of ``_STEPS`` equal steps from ``low`` to ``high`` a value falls in.

    Each operation keeps the order of its arguments, so steps are runs of neighbouring values. Halves
    are taken so that differences don't overflow; the ends have their own branches.
    """
    part = (value / 2 - low / 2) / (high / 2 - low / 2)
    inner = F.least(F.floor(part * _STEPS), F.lit(_STEPS - 1))
    return F.when(value <= low, 0).when(value >= high, _STEPS - 1).otherwise(inner).cast("int")


def _narrow(
    numbers: DataFrame, brackets: dict[str, _Bracket], at: dict[str, float]
) -> dict[str, _Bracket]:
    """For each column the step that holds the lower of the two ranks next to its quantile."""

    def per_feature(values: dict[str, float]) -> Column:
        pairs = [F.lit(x) for n, v in values.items() for x in (n, float(v))]
        return F.create_map(*pairs)[F.col("feature")]

    low = per_feature({n: max(b.low, -_LARGEST) for n, b in brackets.items()})
    high = per_feature({n: min(b.high, _LARGEST) for n, b in brackets.items()})
    counts = (
        _long(numbers, brackets)
        .groupBy("feature", _step(F.col("value"), low, high).alias("step"))
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()  # at most _STEPS rows per column
    )
    narrowed = {}
    for name, bracket in brackets.items():
        below = bracket.below
        rows = sorted((r for r in counts if r["feature"] == name), key=lambda r: r["step"])
        for row, following in zip(rows, [*rows[1:], None]):
            if math.floor(at[name]) < below + row["n"]:
                break
            below += row["n"]
        above = bracket.above
        if math.ceil(at[name]) >= below + row["n"] and following is not None:
            above = following["low"]
        narrowed[name] = _Bracket(below, row["n"], row["low"], row["high"], above)
    return narrowed


def _ranked(
    numbers: DataFrame, brackets: dict[str, _Bracket], at: dict[str, float]
) -> dict[str, float]:
    def per_feature(values: dict[str, int]) -> Column:
        pairs = [F.lit(x) for n, v in values.items() for x in (n, v)]
        return F.create_map(*pairs)[F.col("feature")]

    lower = per_feature({n: math.floor(at[n]) - b.below for n, b in brackets.items()})
    upper = per_feature({n: math.ceil(at[n]) - b.below for n, b in brackets.items()})
    upto = Window.partitionBy("feature").orderBy("value")
    ranked = (
        _long(numbers, brackets)
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
        .groupBy("feature")
        .agg(
            F.min(F.when(F.col("upto") > lower, F.col("value"))).alias("lower"),
            F.min(F.when(F.col("upto") > upper, F.col("value"))).alias("upper"),
        )
        .collect()  # one row per column
    )
    found = {}
    for r in ranked:
        name, low = r["feature"], r["lower"]
        high = brackets[name].above if r["upper"] is None else r["upper"]
        found[name] = low if high == low else low + (high - low) * (at[name] - math.floor(at[name]))
    return found
