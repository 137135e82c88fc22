"""The two ways of counting a pair in the least cell that it shares."""

from __future__ import annotations

import numpy as np
import pytest

from tillroll.llm import lattice


def group(rng, n, kinds, width, crowd):
    own = lattice._Group.__new__(lattice._Group)
    own.node, own.copies = np.arange(n), rng.integers(1, 1 << 40, n)
    own.cell = kinds // 2
    # Cells may repeat within a row, as hashes may.
    own.cells = np.sort(np.column_stack([rng.integers(0, kinds, (n, width - 1)), np.full(n, own.cell)]), axis=1)
    near = rng.random((n, n)) < crowd
    own.near = (near | near.T) & ~np.eye(n, dtype=bool)
    return own


def plain(own):
    total = [0] * len(own.node)
    for a in range(len(total)):
        for b in range(a):
            if own.near[a, b] and min(set(own.cells[a].tolist()) & set(own.cells[b].tolist())) == own.cell:
                total[a] += int(own.copies[b])
                total[b] += int(own.copies[a])
    return total


@pytest.mark.parametrize("gain", [0, 1 << 60], ids=["pairs", "product"])
@pytest.mark.parametrize("kinds, crowd", [(20, 0.5), (400, 0.9), (5000, 0.05), (5000, 1.0), (40, 0.0)])
def test_both_ways_equal_the_plain_count(monkeypatch, gain, kinds, crowd):
    monkeypatch.setattr(lattice, "PRODUCT_GAIN", gain)
    monkeypatch.setattr(lattice, "PAIRS_PER_ROW", 0)
    monkeypatch.setattr(lattice, "WIDTH", 64)
    rng = np.random.default_rng(kinds)
    for n in (1, 2, 33):
        own = group(rng, n, kinds, 10, crowd)
        assert own.counts().tolist() == plain(own)
