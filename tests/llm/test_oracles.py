from __future__ import annotations

import math

import pytest

from checks.compare import connect
from hearthline.llm.queries import ORACLES, QUERIES


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_both_engines_agree(spark, small, name):
    got = QUERIES[name](spark, small)
    result = connect(small).execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert set(names) == set(got.columns)
    theirs = sorted(tuple(map(_cell, r)) for r in result.fetchall())
    assert sorted(tuple(map(_cell, r)) for r in got.select(*names).collect()) == theirs
