"""Randomised agreement of the bin expressions with NumPy."""

import numpy as np
from pyspark.sql import functions as F

from probscope.functions import bins as B


def test_closed_histogram_matches_numpy_random(spark):
    rng = np.random.default_rng(42)
    for lo, hi, n in [(0.0, 1.0, 20), (-1.3, 2.7, 7), (2222.0, 2242.0, 10), (-30.0, 100.0, 26)]:
        xs = np.concatenate([rng.uniform(lo - 0.1 * (hi - lo), hi + 0.1 * (hi - lo), 3000),
                             np.linspace(lo, hi, n + 1), [lo, hi]])
        df = spark.createDataFrame([(float(x),) for x in xs], "x double")
        got = [r[0] for r in df.select(B.closed_histogram_bin("x", lo, hi, n)).collect()]
        edges = np.linspace(lo, hi, n + 1)
        for x, b in zip(xs, got):
            if x < lo or x > hi:
                assert b is None
            else:
                counts, _ = np.histogram([x], bins=edges)
                assert int(np.argmax(counts)) + 1 == b, (lo, hi, n, x)


def test_width_bucket_formula_random(spark):
    rng = np.random.default_rng(7)
    xs = np.concatenate([rng.uniform(-0.2, 1.2, 5000), np.linspace(0, 1, 1001)])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in df.select(B.probbin(F.col("x"))).collect()]
    for x, b in zip(xs, got):
        want = 0 if x < 0 else 21 if x >= 1 else int(np.floor(20.0 * (x - 0.0) / (1.0 - 0.0))) + 1
        assert b == want, x
