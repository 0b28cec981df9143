"""Bucket refinement against counted windows."""

from __future__ import annotations

import tracemalloc
from collections import Counter

import numpy as np
import pytest

from vitalwatch.llm.suffixes import _heads, repeated


@pytest.mark.parametrize("letters", [1, 2, 256])
@pytest.mark.parametrize("length", [8, 9, 50, 200])
def test_windows_met_twice(letters, length):
    rng = np.random.default_rng(length + letters)
    buf = rng.integers(0, letters, 1200).astype(np.uint8)
    buf[-length - 3:] = buf[:length + 3]
    starts = np.unique(np.r_[0, 1200 - length - 3, rng.integers(0, 1200 - length, 300)])
    raw = buf.tobytes()
    seen = Counter(raw[s:s + length] for s in starts.tolist())
    assert repeated(buf, starts, length).tolist() == [seen[raw[s:s + length]] > 1 for s in starts.tolist()]


def test_places_of_buckets():
    assert _heads(np.array([3, 3, 5, 9, 9, 9])).tolist() == [0, 0, 2, 3, 3, 3]
    assert _heads(np.array([7])).tolist() == [0]


@pytest.mark.parametrize("letters", [2, 256])
def test_refinement_holds_few_bytes_a_byte(letters):
    buf = np.random.default_rng(letters).integers(0, letters, 300_000).astype(np.uint8)
    buf[150_000:] = buf[:150_000]
    tracemalloc.start()
    try:
        assert repeated(buf, np.r_[0:149_000:40, 150_000:299_000:40], 200).all()
        assert tracemalloc.get_traced_memory()[1] < 60 * len(buf)  # 73 to 83 a byte when every array was of 8 bytes and held to the end
    finally:
        tracemalloc.stop()
