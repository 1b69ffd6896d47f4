"""The trees learn from every span of the corpus."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from probscope.llm import boosting, pii


def test_frame_and_arrays_give_the_same_trees(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, (600, 4)).astype(float)
    y = ((x[:, 0] > 20) ^ (x[:, 1] > 30)).astype(float)
    rows = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(x, y)], "x array<double>, y double")
    counted = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    a = boosting.Booster(trees=4).fit(x, y)
    b = boosting.Booster(trees=4).fit_frame(counted)
    assert np.allclose(a.predict(x), b.predict(x), atol=1e-4)


def test_every_span_is_learnt_from(spark, monkeypatch):
    """More spans than the former limit of each kind: none is left out of the training rows."""
    seen = []

    class Stop(Exception):
        pass

    def stop(self, rows):
        seen.append(rows)
        raise Stop

    monkeypatch.setattr(boosting.Booster, "fit_frame", stop)
    docs = spark.range(1_800).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("write to a"), F.repeat(F.lit("b"), (F.col("id") % 60).cast("int")), F.col("id"), F.lit("@mail.example.com now")).alias("text"))
    with pytest.raises(Stop):
        pii.train(docs)
    some = [(f"a{'b' * (i % 60)}{i}@mail.example.com") for i in range(1_800)]
    want = sum(1 for v in some for _, _, h in pii.training_rows("email", v, "write to ", " now", 1) if not h)
    assert seen[0].agg(F.sum("n")).first()[0] == want and want > 1_500


def test_tasks_of_a_pass_follow_from_the_rows(spark, monkeypatch):
    """Rows that a shuffle has left in many partitions are read by few tasks, each of which sends its sums."""
    seen = []

    class Stop(Exception):
        pass

    def stop(self, rows):
        seen.append(rows)
        raise Stop

    monkeypatch.setattr(boosting.Booster, "fit_frame", stop)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("write to a"), F.repeat(F.lit("b"), (F.col("id") % 60).cast("int")), F.col("id"), F.lit("@mail.example.com now")).alias("text"))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with pytest.raises(Stop):
            pii.train(docs)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    n = seen[0].count()
    assert n > 40 and len(seen[0].inputFiles()) <= -(-n // pii.ROWS_A_TASK) + 1
