"""Edge-case golden rows (FIXTURES.md section 4)."""

import math

import pytest
from pyspark.sql import functions as F

from probscope.functions import bins as B
from probscope.functions import labels as L
from probscope.operators import confusion as cm
from probscope.operators import probhist as ph
from probscope.operators import reshape as rs
from probscope.operators.select_one import argmax
from tests.literal import make_tables, ts


def _col(spark, values, expr, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_tbin_edges(spark):
    assert _col(spark, [-30.001, -30.0, -25.0, 99.999, 100.0], B.tbin) == [0, 1, 2, 26, 27]


def test_probbin_edges(spark):
    assert _col(spark, [-0.1, 0.0, 0.05, 0.15, 0.95, 1.0, 2.0], B.probbin) == [0, 1, 2, 4, 20, 21, 21]


def test_closed_histogram(spark):
    got = _col(spark, [0.15, 0.95, 1.0, 1.01, -0.1], lambda c: B.closed_histogram_bin(c, 0.0, 1.0, 20))
    assert got == [3, 19, 20, None, None]


def test_closed_histogram_matches_numpy(spark):
    import numpy as np
    xs = [i / 1000 for i in range(1001)] + [0.15, 0.3, 0.35, 0.6, 0.7, 0.85, 0.95]
    got = _col(spark, xs, lambda c: B.closed_histogram_bin(c, 0.0, 1.0, 20))
    edges = np.linspace(0, 1, 21)
    for x, b in zip(xs, got):
        counts, _ = np.histogram([x], bins=edges)
        assert int(np.argmax(counts)) + 1 == b, x


def test_diff_bins(spark):
    assert _col(spark, [-1.0, 0.0, 1.0], B.probdiffbin) == [1, 21, 41]


def test_centres(spark):
    assert _col(spark, [-3, 0, 1, 26, 27, 99], B.tbin_val, "int") == [-32.5, -32.5, -27.5, 97.5, 102.5, 102.5]
    assert _col(spark, [0, 1, 20, 21], B.probbin_val, "int") == pytest.approx([-1, 0.025, 0.975, 1])
    assert [round(v, 2) for v in _col(spark, [1, 21, 41], B.probdiff_bin_mean, "long")] == [-1.0, 0.0, 1.0]


def test_null_nan_bucket(spark):
    assert _col(spark, [None, float("nan")], B.probbin) == [None, None]


def test_annotation(spark):
    df = spark.createDataFrame([(7, 0.425), (1234567, 0.5), (1000000, 0.005)], "n long, f double")
    got = [r[0] for r in df.select(L.cell_annotation("n", "f")).collect()]
    assert got == ["42.0%\n7", "50.0%\n1.23e+06", "0.0%\n1e+06"]


def test_taxonomy_order(spark):
    df = spark.createDataFrame([(i,) for i in [10, 2, 21, 210, 3]], "c int")
    rows = df.select("c", L.taxonomy_sort_key("c", 3).alias("k")).orderBy("k", "c").collect()
    assert [r.c for r in rows] == [10, 2, 21, 210, 3]
    assert [r.k for r in rows] == [100, 200, 210, 210, 300]


def test_match_level(spark):
    got = _col(spark, [111, 2000, 2200, 2220, 2222], L.match_level, "int")
    assert got == ["none", "broad", "general", "category", "exact"]


def test_argmax_tie(spark):
    df = spark.createDataFrame([(1, 2223, 0.5), (1, 2222, 0.5)], "m long, class_id int, probability double")
    assert argmax(df, ["m"], "probability", ["class_id"], tie=["class_id"]).first().class_id == 2222
    arr = rs.argmax_from_array(rs.messages_as_arrays(
        df.withColumnRenamed("m", "broker_message_id").withColumn("classifier_id", F.lit(1))))
    assert arr.first().class_id == 2222


def test_expected_probability(spark):
    hist = spark.createDataFrame([(1, 2222, 2222, 5, 1, 1), (1, 2222, 2222, 5, 2, 3)],
                                 "classifier_id int, class_id int, true_class_id int, tbin long, probbin long, n long")
    got = ph.expected_probability(hist).first().prob
    assert got == pytest.approx(0.75 * 0.075)


def _tables(spark):
    # objects: 1 sent+classified, 2 sent+unclassified (missed), 3 never sent + classified,
    # 4 never sent, unclassified; 5 gentype 10 (fan-out checks use the hier map)
    truth = [(1, 10, 100.0), (2, 20, 100.0), (3, 30, 100.0), (4, 10, 100.0)]
    sources = [(11, 1, 100.0, "r"), (12, 1, 101.0, "g"), (21, 2, 100.0, "r"), (31, 3, 100.0, "r"),
               (41, 4, 100.0, "r")]
    alerts = [(111, 11, 1, None), (112, 12, 1, ts(2)), (121, 21, 2, ts(1)), (131, 31, 3, None),
              (141, 41, 4, None)]
    messages = [(1001, 111, ts(5)), (1002, 112, ts(6)), (1003, 131, ts(5))]
    cls = [(1001, 1, 2222, 0.1), (1001, 1, 2223, 0.05), (1002, 1, 2223, 0.9), (1002, 1, 2222, 0.05),
           (1003, 1, 2224, 0.7)]
    return make_tables(spark, truth, sources, alerts, messages, cls)


def test_last_best_null_sent_time_wins(spark):
    t = _tables(spark)
    best = {r.dia_object_id: r.class_id for r in cm.chosen_classification(t, "last_best").collect()}
    assert best[1] == 2222  # NULL sent time sorts first under DESC (PostgreSQL rule)


def test_best_tie_goes_to_latest(spark):
    t = _tables(spark)
    t.broker_classification = spark.createDataFrame(
        [(1001, 1, 2222, 0.5), (1002, 1, 2223, 0.5)], t.broker_classification.schema)
    best = {r.dia_object_id: r.class_id for r in cm.chosen_classification(t, "best").collect()}
    assert best[1] == 2222  # equal p: the NULL (first under DESC) alert wins, as for t2 > t1


def test_missed_and_never_sent(spark):
    t = _tables(spark)
    inner = {(r.classifier_id, r.pred_class, r.true_class): r.n for r in cm.confusion_counts(t).collect()}
    assert inner == {(1, 2222, 2222): 1, (1, 2224, 2224): 1}  # object 3 counted without include_missed
    missed = {(r.classifier_id, r.pred_class, r.true_class): r.n
              for r in cm.confusion_counts(t, include_missed=True).collect()}
    assert missed[(1, 2222, 2222)] == 1
    assert missed[(1, -1, 2223)] == 1          # object 2: sent, never classified
    assert (1, 2224, 2224) not in missed       # object 3: classified but never sent
    assert all(k[2] != 2224 for k in missed)   # never-sent objects are absent
    for cfer in (2, 3, 4, 5):                  # classifiers without data: all missed
        assert missed[(cfer, -1, 2222)] == 1 and missed[(cfer, -1, 2223)] == 1


def test_fan_out_counts_in_both(spark):
    t = _tables(spark)
    rows = cm.confusion_counts(t, hierarchical=True).collect()
    trues = sorted(r.true_class for r in rows if r.pred_class == 2222)
    assert trues == [2000, 2200, 2220, 2222]


def test_norm_of_empty_row_is_zero(spark):
    counts = spark.createDataFrame([(1, 2222, 2222, 0)], "classifier_id int, pred_class int, true_class int, n long")
    assert cm.normalize(counts, "true").first().fraction == 0.0


def test_nan_probability_ranks_highest(spark):
    df = spark.createDataFrame([(1, 2222, 0.9), (1, 2223, float("nan"))], "m long, class_id int, probability double")
    assert math.isnan(argmax(df, ["m"], "probability", ["probability"]).first().probability)


def test_bucketed_detection_ordinals_equal_plain_ranking(tables):
    from pyspark.sql import Window
    from probscope.operators.diagnostics import detection_ordinals
    w = Window.partitionBy("dia_object_id").orderBy("mid_point_tai", "dia_source_id")
    plain = tables.diasource.select("dia_source_id", F.row_number().over(w).alias("detection"))
    for days in (1.0, 7.0, 1000.0):
        got = detection_ordinals(tables, days)
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_best_equal_probability_goes_to_later_alert(spark):
    t = make_tables(spark, [(1, 10, 100.0)], [(11, 1, 100.0, "r"), (12, 1, 101.0, "r")],
                    [(111, 11, 1, ts(1)), (112, 12, 1, ts(2))],
                    [(1001, 111, ts(5)), (1002, 112, ts(6))],
                    [(1001, 1, 2222, 0.6), (1002, 1, 2224, 0.6), (1001, 1, 2223, 0.4), (1002, 1, 2223, 0.4)])
    best = cm.chosen_classification(t, "best").first()
    assert best.class_id == 2224  # equal p: the alert sent at t2 > t1 wins
    last = cm.chosen_classification(t, "last_best").first()
    assert last.class_id == 2224
