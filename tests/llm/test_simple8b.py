from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopfunnel.llm.simple8b import decode, encode

VALUES = st.one_of(st.integers(0, 1), st.integers(0, 9), st.integers(0, 50_256), st.integers(0, 2**32 - 1), st.integers(0, 2**64 - 1))


def back(values):
    words, offsets = encode(np.array(values, dtype=np.uint64))
    return decode(words, offsets, len(values)).tolist(), words, offsets


@settings(max_examples=200, deadline=None)
@given(st.lists(VALUES, max_size=300))
def test_round_trip(values):
    assert back(values)[0] == values


@pytest.mark.parametrize("top", [1, 2, 16, 1 << 15, 50_257, 1 << 32, 1 << 61])
def test_round_trip_over_blocks(top):
    values = np.random.default_rng(top % 97).integers(0, top, 7000).tolist()
    assert back(values)[0] == values


def test_narrow_values_take_few_words():
    assert len(back([1] * 6000)[1]) == 5 * 18 + 15  # 60 values a word, block by block
    assert len(back([40_000] * 3072)[1]) == 3 * 342
    assert len(back([2**63] * 5)[1]) == 10


def test_blocks_decode_alone():
    values = np.random.default_rng(5).integers(0, 60_000, 3000).astype(np.uint64)
    words, offsets = encode(values)
    assert len(offsets) == 4
    middle = decode(words[offsets[1] : offsets[2]], offsets[1:3] - offsets[1], 1024)
    assert middle.tolist() == values[1024:2048].tolist()
