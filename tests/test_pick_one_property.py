"""pick_one (max_by over a struct key) vs sorting with explicit NULL placement."""

import random

from probscope.operators.select_one import pick_one


def _brute(rows, order):
    """order: list of (index, 'asc'|'desc', nulls_first). Returns the first row per group."""
    def key(r):
        parts = []
        for i, direction, nulls_first in order:
            v = r[i]
            null_rank = 0 if (v is None) == nulls_first else 1
            if v is None:
                parts += [null_rank, 0]
            else:
                parts += [null_rank, v if direction == "asc" else -v]
        return parts
    best = {}
    for r in rows:
        if r[0] not in best or key(r) < key(best[r[0]]):
            best[r[0]] = r
    return best


def test_pick_one_matches_sorting(spark):
    rnd = random.Random(3)
    for trial in range(6):
        rows = []
        for i in range(400):
            g = rnd.randint(0, 30)
            a = None if rnd.random() < 0.2 else rnd.randint(0, 4)
            b = None if rnd.random() < 0.2 else float(rnd.choice([0.0, 0.5, 1.0]))
            rows.append((g, a, b, i))  # i: unique tie-breaker
        df = spark.createDataFrame(rows, "g int, a int, b double, i int")
        dirs = [(1, rnd.choice(["asc", "desc"]), rnd.random() < 0.5), (2, rnd.choice(["asc", "desc"]),
                                                                         rnd.random() < 0.5), (3, "asc", False)]
        names = {1: "a", 2: "b", 3: "i"}
        order = [(names[i], d, nf) for i, d, nf in dirs]
        got = {r.g: r.i for r in pick_one(df, ["g"], order, ["i"]).collect()}
        want = {g: r[3] for g, r in _brute(rows, dirs).items()}
        assert got == want, (trial, order)
