from __future__ import annotations

import math
import random

import pytest

from stratalake.operators import profile


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def expected(values, fraction):
    ordered = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    return ordered[max(1, math.ceil(fraction * len(ordered))) - 1] if ordered else None


RANDOM = random.Random(7)
SAMPLES = {
    "uniform": [RANDOM.uniform(-5, 5) for _ in range(999)],
    "heavy tail": [math.exp(RANDOM.uniform(0, 30)) for _ in range(1000)],
    "a third equal": [1.5] * 400 + [RANDOM.uniform(0, 100) for _ in range(800)],
    "nulls": [None, 3.0, None, 1.0, 2.0],
    "one": [4.0],
    "largest doubles": [-1.7e308, 1.7e308, 0.0, 1.6e308],
    "cents": [round(RANDOM.uniform(0, 20), 2) for _ in range(3000)],
    "infinities": [-math.inf, -math.inf, 1.0, 2.0, math.inf],
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("finish_rows", [1, 1_000_000])
def test_quantiles_are_exact(spark, name, finish_rows):
    values = SAMPLES[name]
    df = frame(spark, values)
    for fraction in (0.0, 0.5, 0.99):
        found = profile.exact_quantile(df, "v", fraction, finish_rows=finish_rows, buckets=16)
        assert found == expected(values, fraction), (name, fraction)


def test_quantile_of_nothing_and_of_nan(spark):
    assert profile.exact_quantile(frame(spark, []), "v", 0.5) is None
    assert profile.exact_quantile(frame(spark, [None]), "v", 0.5) is None
    nan = float("nan")
    assert profile.exact_quantile(frame(spark, [1.0, nan, nan]), "v", 0.1) == 1.0
    assert math.isnan(profile.exact_quantile(frame(spark, [1.0, nan, nan]), "v", 0.9))


def test_profile_row(spark):
    row = profile.numeric_profile(frame(spark, [1.004, 2.0, 10.0, None]), "v").first()
    assert tuple(row) == (1.0, 4.33, 2.0, 10.0)
    assert tuple(profile.numeric_profile(frame(spark, []), "v").first()) == (None, None, None, None)


def test_distribution_puts_null_first(spark):
    out = profile.distribution(frame(spark, [2.0, None, 1.0, 2.0]), "v").collect()
    assert [tuple(r) for r in out] == [(None, 1), (1.0, 1), (2.0, 2)]
