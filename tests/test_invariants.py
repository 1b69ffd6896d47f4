"""Invariants the analyses rely on (checked at sf0.001)."""

import pytest
from pyspark.sql import functions as F

from probscope.operators import confusion as cm
from probscope.operators import probdiff as pd
from probscope.operators import probhist as ph
from probscope.operators import relday as rd


def test_clean_messages_sum_to_one(tables):
    per = tables.broker_classification.groupBy("broker_message_id").agg(F.sum("probability").alias("s"))
    ones = per.where(F.abs(F.col("s") - 1.0) < 1e-9).count()
    halves = per.where(F.abs(F.col("s") - 0.5) < 1e-9).count()
    assert ones + halves == per.count()


def test_probdiff_fractions_sum_to_one(tables):
    h = pd.probdiff_hist(tables)
    sums = h.groupBy(*pd.GROUP).agg(F.sum("frac").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0


def test_normalised_rows_sum_to_one(tables):
    counts = cm.confusion_counts(tables, include_missed=True)
    for norm, keys in cm.NORM_KEYS.items():
        s = cm.normalize(counts, norm).groupBy(*keys).agg(F.sum("fraction").alias("s"))
        assert s.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0, norm


def test_confusion_column_sums_to_objects(tables):
    col = rd.peak_confusion_column(tables)
    stats = rd.closest_to_peak_stats(tables)
    a = {(r.classifier_id, r.true_class_id): r.n for r in
         col.groupBy("classifier_id", "true_class_id").agg(F.sum("n").alias("n")).collect()}
    b = {(r.classifier_id, r.true_class_id): r.n_objects for r in stats.collect()}
    assert a == b
    pct = col.groupBy("classifier_id", "true_class_id").agg(F.sum("percent").alias("p")).collect()
    assert all(r.p == pytest.approx(100.0) for r in pct)


def test_probhist_total_equals_dedup_rows(tables):
    total = ph.probhist(tables).agg(F.sum("n")).first()[0]
    assert total == ph.dedupe_mean(tables).count()


def test_missed_plus_classified_equals_sent(tables):
    counts = cm.confusion_counts(tables, include_missed=True)
    per = counts.groupBy("classifier_id", "true_class").agg(F.sum("n").alias("n")).collect()
    by_true = {}
    for r in per:
        by_true.setdefault(r.true_class, set()).add(r.n)
    assert all(len(v) == 1 for v in by_true.values())  # every classifier sees all sent objects
