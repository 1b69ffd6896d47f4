"""Inputs that must not be lost or bent silently."""

import math
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from probscope.functions import exact as X
from probscope.operators import catalog as cat
from probscope.operators import confusion as cm
from probscope.operators import explore as ex
from probscope.operators import relday as rd
from probscope.operators.quantiles import exact_quantiles
from probscope.operators.select_one import argmin
from probscope.session import checkpoint_root
from probscope.sources import dims, io
from tests.literal import make_tables, ts


def _sum(spark, values, f=X.fsum):
    return spark.createDataFrame([(v,) for v in values], "x double").agg(f("x")).first()[0]


def test_small_values_are_not_cut(spark):
    assert _sum(spark, [1e-10, 2e-10], X.fmean) == 1.5e-10
    assert _sum(spark, [1e-300] * 4) == 4e-300


def test_nan_and_infinity_come_through(spark):
    assert math.isnan(_sum(spark, [float("nan"), 0.5, 2.0], X.fmean))
    assert _sum(spark, [float("inf"), 0.5]) == float("inf")
    assert math.isnan(_sum(spark, [float("inf"), float("-inf")]))
    assert _sum(spark, [None, 0.25]) == 0.25 and _sum(spark, [None]) is None


def test_large_sums_do_not_overflow(spark):
    assert _sum(spark, [3.9e9] * 1000) == 3.9e12
    assert _sum(spark, [1e200, 1.0]) == 1e200


def test_sums_are_right_in_any_order(spark):
    rng = random.Random(1)
    xs = [rng.randrange(1, 90) / rng.randrange(90, 640) for _ in range(3000)]
    for _ in range(3):
        rng.shuffle(xs)
        assert _sum(spark, xs) == math.fsum(xs)


def test_missing_catalogue_is_an_error(spark, tables, tmp_path):
    root = str(tmp_path)
    for name in io.DATA_TABLES:
        getattr(tables, name).limit(5).write.parquet(f"{root}/{name}")
    with pytest.raises(AnalysisException):
        io.read_tables(spark, root)
    given = {"gentype": dims.gentype_of_classid(spark), "gentype_hier": dims.gentype_of_classid(spark, True),
             "classifiers": dims.broker_classifier(spark), "timebins": dims.maxprob_timebins(spark),
             "confusion_classes": dims.confusion_classes(spark)}
    assert io.read_tables(spark, root, given).truth.count() == 5
    with pytest.raises(ValueError):
        io.read_tables(spark, root, given | {"gentypes": given["gentype"]})


def test_ascending_pick_puts_nan_last(spark):
    rows = spark.createDataFrame([(1, float("nan"), 7), (1, 0.5, 8), (1, 2.0, 9), (2, float("nan"), 5), (3, None, 4), (3, 1.0, 6)],
                                 "g int, v double, k int")
    assert {r.g: r.k for r in argmin(rows, ["g"], "v", ["k"]).collect()} == {1: 8, 2: 5, 3: 6}


def test_nan_deltat_is_not_closest_to_peak(spark):
    t = make_tables(spark, [(1, 10, 100.0)], [(11, 1, float("nan"), "r"), (12, 1, 130.0, "r")],
                    [(21, 11, 1, ts(1)), (22, 12, 1, ts(2))], [(31, 21, ts(3)), (32, 22, ts(3))],
                    [(31, 1, 2222, 0.9), (32, 1, 2223, 0.8)])
    assert [(r.dia_source_id, r.class_id) for r in rd.closest_to_peak_picks(t).collect()] == [(12, 2223)]


@pytest.mark.parametrize("zone", ["UTC", "America/Santiago"])
def test_offsets_of_iso_text(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-01-01T10:00:00.250000+02:00", "2024-01-01T08:00:00.250000+00:00", "2024-01-01T08:00:00.250000Z",
                 "2024-01-01T08:00:00.250000", "1969-12-31T23:59:59.5-0100", None]
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(io.iso_text(io.parse_iso("t")).alias("t"))
        got = [r.t for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2024-01-01T08:00:00.250000"] * 4 + ["1970-01-01T00:59:59.500000", None]


def test_other_classes_never_match(spark):
    classes = spark.createDataFrame([(2222, "SNIa"), (2322, "Pulsator/Other"), (100, "Residual"), (2300, "Periodic"), (2400, None)],
                                    "class_id int, description string")
    got = {r.class_id: r.level for r in cat.with_match_levels(classes).collect()}
    assert got == {2222: "exact", 2322: "none", 100: "none", 2300: "general", 2400: "general"}
    counts = spark.createDataFrame([(1, 2322, 2322, 5), (1, 2222, 2222, 3)], "classifier_id int, pred_class int, true_class int, n long")
    rates = {(r.true_class, r.level): r.n_match for r in cat.match_rate_by_level(counts, classes).collect()}
    assert rates[2322, "exact"] == rates[2322, "broad"] == 0 and rates[2222, "exact"] == 3


def test_pivot_counts_classes_outside_the_list(spark):
    rows = spark.createDataFrame([(1, 1, 0.0, 2222, 0.25), (1, 1, 0.0, 9999, 0.5), (1, 1, 0.0, None, 0.5)],
                                 "classifier_id int, dia_object_id long, deltat double, class_id int, probability double")
    r = ex.prob_matrix(rows, [2222]).first()
    assert (r.class_2222, r.n_other) == (0.25, 2)


def test_unknown_gentype_stays_in_counts_of_sent_objects(tables):
    assert tables.truth.join(tables.gentype, "gentype", "left_anti").count() == 0  # the fixture lists all it uses
    assert cm.sent_objects(tables).count() > 0


def test_message_ids_are_unique(tables):
    m = tables.broker_message
    assert m.select("broker_message_id").distinct().count() == m.count()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 30_000])
def test_exact_quantiles(spark, n):
    """Also of a group far beyond the size of a sketch, dealt over many tasks."""
    rng = random.Random(n)
    xs = [rng.choice([rng.random(), 0.5, 0.0]) for _ in range(n)]
    df = spark.createDataFrame([("a", x) for x in xs] + [("b", 1.0), ("b", None), ("b", float("nan"))], "g string, x double")
    got = exact_quantiles(df.repartition(7), ["g"], "x", {"q25": 0.25, "q50": 0.5, "q99": 0.99}, F.floor(F.col("x") * 100))
    rows = {r.g: (r.q25, r.q50, r.q99) for r in got.collect()}
    xs.sort()
    assert rows == {"a": tuple(xs[max(math.ceil(p * n - 1e-9), 1) - 1] for p in (0.25, 0.5, 0.99)), "b": (1.0,) * 3}


def test_listings_come_in_order(tables):
    keys = [r.sort_key for r in cat.taxonomy_order(tables).collect()]
    assert keys == sorted(keys) and keys[0] == -1
    titles = [r.sort_key for r in cat.classifier_catalog(tables).collect()]
    assert titles == sorted(titles)
    objs = tables.truth.select("dia_object_id").limit(3)
    times = [(r.dia_object_id, r.mid_point_tai) for r in ex.light_curve(tables, objs).collect()]
    assert times == sorted(times) and times


def test_no_local_folder_off_local_mode(spark):
    class Cluster:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Cluster
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError):
        checkpoint_root(Session)
