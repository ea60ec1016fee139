from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from hearthline.llm.textwords import ALPHANUMERIC, SPACED, chunks, grams, words
from tests.llm.conftest import plain, spaced

TEXT = st.text(alphabet=" \t\n\r\x00ab1Z-_.éß漢 ", max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, size):
    column = pa.array(texts, pa.string())
    for kind, pattern in ((SPACED, spaced), (ALPHANUMERIC, plain)):
        got = []
        for chunk in chunks(column, size):
            found = words(chunk, kind)
            at = [found.data[a:b].tobytes().decode() for a, b in zip(found.start, found.end)]
            got += [at[a:b] for a, b in zip(found.bounds[:-1], found.bounds[1:])]
        assert got == [pattern(t) for t in texts]


def test_hashes_tell_words_and_their_order():
    chunk = next(chunks(pa.array(["a b a ab ba aa a\x00 " + "x" * 9000 + " " + "x" * 9001])))
    hashes = words(chunk, SPACED).hashes()
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == len(hashes) - 1
    two = grams(hashes, 2)
    assert two[0] != two[1] and len(grams(hashes[:1], 2)) == 0


def test_a_sliced_column_keeps_its_offsets():
    column = pa.array(["one", None, "two three", ""]).slice(1)
    found = [words(c, SPACED).counts().tolist() for c in chunks(column)]
    assert np.concatenate(found).tolist() == [0, 2, 0]
