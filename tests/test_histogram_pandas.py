"""The Spark histogram against ``pd.cut(x, bins=20)`` itself (brute force)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from shelfwise.operators.dashboard import histogram


def pandas_bins(values: np.ndarray):
    cats = pd.cut(pd.Series(values), bins=20)
    counts = cats.value_counts().sort_index()
    return [(float(iv.left), float(iv.right), int(c)) for iv, c in counts.items()]


CASES = {
    "uniform": lambda r: r.uniform(0, 100_000, 5_000),
    "normal": lambda r: r.normal(50, 12, 5_000),
    "integer_ties": lambda r: r.integers(0, 40, 5_000).astype(float),
    "negative": lambda r: r.uniform(-500, -3, 3_000),
    "tiny_range": lambda r: r.uniform(0.0001, 0.0009, 2_000),
    "sub_one": lambda r: r.uniform(0, 1, 2_000),
    "large": lambda r: r.uniform(1e9, 1e9 + 5e5, 2_000),
    "two_values": lambda r: np.array([3.0] * 50 + [7.5] * 20),
    "constant": lambda r: np.array([5.0] * 10),
    "constant_zero": lambda r: np.array([0.0] * 4),
    "prices": lambda r: np.round(r.uniform(900, 105_000, 5_000), 2),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_histogram_matches_pd_cut(spark, case):
    values = CASES[case](np.random.default_rng(7))
    frame = spark.createDataFrame(pd.DataFrame({"total_sales": values.astype(float)}))
    got = [(r.bin_start, r.bin_end, r["count"]) for r in histogram(frame).orderBy("bin").collect()]
    assert got == pandas_bins(values)
