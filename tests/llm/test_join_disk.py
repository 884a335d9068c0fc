"""What the join's groups move: bitmaps of under three bits a token, and no set ruled out wrongly."""

from __future__ import annotations

import numpy as np

from docloom.llm import ngramjoin as J


def test_bitmaps_are_narrow_and_safe():
    r = np.random.default_rng(5)
    base = np.unique(r.integers(0, 1 << 63, 500, dtype=np.uint64))
    sets = [base, np.sort(r.permutation(base)[:460]), np.unique(r.integers(0, 1 << 63, 500, dtype=np.uint64))]
    sigs = [J.signature(s) for s in sets]
    assert all(len(s) * 8 < 3 * 450 for s in sigs)
    i, j, _ = J.likely_pairs(np.array([s.size for s in sets]), sigs, np.ones(3, bool))
    assert {frozenset(p) for p in zip(i.tolist(), j.tolist())} == {frozenset((0, 1))}
