"""The estimate's limit loses fewer pairs at the threshold than the banding does."""

from __future__ import annotations

from math import comb

from bidbox.llm import bagminhash


def test_a_pair_at_the_threshold_is_verified():
    n, p = bagminhash.REGISTERS, 0.8
    least = (p - bagminhash.SLACK) * n
    under = sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1) if k < least)
    no_band = (1 - p**bagminhash.ROWS) ** bagminhash.BANDS
    assert under < no_band
