"""Numbers of op10 are stored and sent as planes of bytes, which compress better than the numbers as they are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tarmac.llm.kneser_ney import _all_of, _from_planes, _planes


@pytest.mark.parametrize("kind", [np.uint32, np.int64])
def test_planes_give_the_numbers_back_and_compress(kind):
    numbers = (np.random.default_rng(1).pareto(1, 50_000) * 9).clip(0, 1e9).astype(kind)
    assert (_from_planes(_planes(numbers), kind) == numbers).all()
    assert (_all_of([_planes(numbers[:7]), _planes(numbers[:0]), _planes(numbers[7:])], kind) == numbers).all()
    assert len(_all_of([], kind)) == 0
    assert len(pa.compress(_planes(numbers), "lz4_raw", asbytes=True)) < 0.8 * len(pa.compress(numbers.tobytes(), "lz4_raw", asbytes=True))
