"""Hard negatives against a plain search, odd rows, ties and the multiplication itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from probscope.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("m,d,n", [(1, 1, 1), (70, 65, 99), (33, 128, 77), (64, 64, 64), (100, 3, 200), (0, 5, 7)])
def test_multiply(m, d, n):
    r = np.random.RandomState(m + d + n)
    a, b = r.randint(-10 ** 9, 10 ** 9, (m, d)), r.randint(-10 ** 9, 10 ** 9, (d, n))
    assert (hard_negatives.multiply(a, b) == a @ b).all()


def test_multiply_wraps_exactly():
    """Sums on the way pass 64 bits, the products do not."""
    a = np.full((64, 64), 2 ** 27, np.int64)
    assert (hard_negatives.multiply(a, a, 8) == 64 * 2 ** 54).all()


def plain(rows, positives=5, negatives=5):
    ok = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256.0 * float(np.float32(x)))) for x in v]
        if sum(x * x for x in q) < 2 ** 62:
            ok[i] = min(ok.get(i, (y, q)), (y, q))
    out = []
    for a in (i for i in ok if i % 100 == 0):
        score = {i: sum(x * y for x, y in zip(ok[a][1], q)) for i, (_, q) in ok.items()}
        order = sorted((i for i in ok if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in order if ok[i][0] == ok[a][0]][:positives]:
            found = [i for i in order if ok[i][0] != ok[a][0] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(found[:negatives])]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("id") % 100 == 0, **more).collect())


@pytest.fixture(scope="module")
def rows():
    """Few values, hence many ties, beside random ones."""
    r = np.random.RandomState(3)
    out = [(i, [float(x) for x in r.choice([0.0, 0.01, 0.5], 7)], int(r.randint(3))) for i in range(350)]
    return out + [(1000 + i, [float(x) for x in r.randn(7) - 0.3], int(r.randint(3))) for i in range(350)]


def test_mine(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = plain(rows)
    assert len(want) > 30 and mined(df) == want
    # tiles, strips and blocks of a few rows change nothing
    monkeypatch.setattr(hard_negatives, "TILE", 16)
    monkeypatch.setattr(hard_negatives, "STRIP", 2)
    monkeypatch.setattr(hard_negatives, "BLOCK_CELLS", 21)
    assert mined(df) == want
    assert mined(df, positives=2, negatives=1) == plain(rows, 2, 1)


def test_odd_rows(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.9, 1.0], 2), (3, None, 2), (4, [1.0, None], 2), (5, [nan, 1.0], 2),
            (6, [1.0, inf], 2), (7, [1.0, 1.0], None), (None, [1.0, 1.0], 2), (8, [], 2), (9, [1.0], 2), (10, [1.0, 0.8, 5.0], 2),
            (11, [1e30, 1.0], 1), (2, [0.9, 1.0], 2), (12, [0.95, 0.95], 3), (12, [1.0, 0.85], 2), (100, [-1.0, 0.0], 1),
            (200, [0.0, 0.0], 4)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("score", F.lit("x"))
    want = plain(rows)
    assert [r[3] for r in want if r[:2] == (0, 1)] == [2, 12, 10] and mined(df) == want
    monkeypatch.setattr(hard_negatives, "SENT", 0)
    assert mined(df) == want
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 1")) == []
    assert hard_negatives.mine(df.limit(0), F.col("id") % 100 == 0).columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
