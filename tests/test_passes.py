"""Work in slices gives what one action gives, and leaves no shuffles and no columns that can be had from others."""

import time

import pytest
from pyspark.sql import functions as F

from probscope.operators import characteristic as ch
from probscope.operators import passes
from probscope.operators import probhist as ph
from probscope.operators import relday as rd
from probscope.operators import verdicts as vd
from probscope.plans import incremental as inc
from probscope.plans.registry import finish
from probscope.sources import fixtures
from tests.literal import make_tables, ts


def rows(df):
    df = finish(df)
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())  # as text, in which NaN equals NaN


@pytest.fixture(scope="module")
def odd(spark):
    """Lone messages, several of a source, a source with two alerts, one of two objects (of one gentype, else the latest message has no single one), an object stored twice, an alert with many
    messages, messages and probabilities stored twice or under two classifiers, a class twice, none, nulls."""
    truth = [(k, 10 * (1 + k % 3), 100.0) for k in range(1, 7)] + [(5, 30, 100.0)]
    sources = [(10 + k, k, 95.0 + k, "r") for k in range(1, 7)] + [(16, 3, 95.0 + 6, "r"), (17, 1, 93.0, "g"), (18, 2, 99.0, "r")]
    alerts = [(20 + k, 10 + k, k, ts(k)) for k in range(1, 7)] + [(26, 16, 3, ts(6)), (27, 17, 1, None), (28, 18, 2, ts(8)), (29, 18, 2, ts(9)),
                                                                  (27, 13, 3, ts(7))]
    messages = [(100 + k, 21 + k % 9, ts(1 + k % 5)) for k in range(60)]
    messages += [(200 + k, 22, ts(1 + k % 3)) for k in range(9)] + [(100, 21, ts(6)), (300, 27, None), (301, None, ts(3))]
    probs = [(m, 1 + m % 4, c, ((m * 7 + c) % 50) / 64) for m in sorted({x[0] for x in messages}) for c in (2222, 2223, 2224)]
    probs += [(105, 1, 2222, None), (106, 3, 2223, float("nan")), (999, 1, 2222, 0.5)]
    t = make_tables(spark, truth, sources, alerts, messages, probs)
    arrays = (t.broker_classification.groupBy("broker_message_id", "classifier_id")
              .agg(F.array_sort(F.collect_list(F.struct("class_id", "probability"))).alias("probs")))
    again = arrays.where("broker_message_id in (107, 112, 205)").withColumn("classifier_id", F.col("classifier_id") % 4 + 1)
    none = arrays.where("broker_message_id = 110").withColumn("classifier_id", F.lit(None).cast("int"))
    t.message_probs = arrays.unionByName(again).unionByName(none).localCheckpoint()
    t.diaforcedsource = t.diasource.select("dia_object_id", "mid_point_tai", F.lit(5.0).alias("ps_flux"), F.lit(0.1).alias("ps_flux_err"),
                                           "filter_name")
    return t.but(context=None)


SLICED = {
    "probhist": ph.probhist,
    "dedupe_mean": ph.dedupe_mean,
    "mean_prob_by_tbin": ph.mean_prob_by_tbin,
    "prob_by_relday": rd.prob_by_relday,
    "confusion_by_alerts": lambda t: vd.confusion_by_alerts(t, 20),
}


@pytest.mark.parametrize("name", sorted(SLICED))
def test_slices_equal_the_whole(odd, monkeypatch, name):
    want = rows(SLICED[name](odd))
    monkeypatch.setattr(passes, "PASS_MESSAGES", 30)
    assert len(want) > 20 and rows(SLICED[name](odd)) == want
    monkeypatch.setattr(passes, "MANY_MESSAGES", 8)
    assert rows(SLICED[name](odd)) == want


def test_scaled_time_in_slices(odd, spark, monkeypatch):
    taus = spark.createDataFrame([(c, 1, 0.5 * c / 2222) for c in (2222, 2223, 2224, 2225, 2235)], "true_class_id int, n_curves long, tau double")
    monkeypatch.setattr(ch, "characteristic_times", lambda t: taus)
    want = rows(ch.mean_prob_by_scaled_time(odd))
    monkeypatch.setattr(passes, "PASS_MESSAGES", 30)
    assert len(want) > 10 and rows(ch.mean_prob_by_scaled_time(odd)) == want


def test_batches_in_slices_equal_a_rebuild(spark, odd, tmp_path, monkeypatch):
    plain = {"probhist": ph.probhist(odd), "mean_prob_by_relday": rd.prob_by_relday(odd).drop("max_probability")}
    want = {name: rows(df) for name, df in plain.items()}
    monkeypatch.setattr(passes, "PASS_MESSAGES", 60)
    for k, batch in enumerate(inc.by_ingest_time(odd, 2)):
        assert inc.commit(batch, str(tmp_path), k, list(want)) == list(want)
    assert {name: rows(inc.read(odd, str(tmp_path), name)) for name in want} == want


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size())}


def test_no_shuffle_outlives_what_is_written(spark, sf_dir, tmp_path):
    """Neither of the tables nor of what is stored between actions; nor is the setting left on."""
    from probscope.session import REMOVE_SHUFFLES
    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(500).write.parquet(str(tmp_path / f"{name}.parquet"))
    setting, before = spark.conf.get(REMOVE_SHUFFLES, None), shuffle_files(spark)
    t = fixtures.load_tables(spark, str(tmp_path))
    assert t.diaalert.count() and t.message_probs.count()
    assert passes.stored([spark.range(999).groupBy((F.col("id") % 7).alias("k")).agg(F.max("id"))], "test").count() == 7
    left = lambda: {f for f in shuffle_files(spark) - before if f.startswith("shuffle")}
    counted = 2 * 4 + 2 * 4  # the counts above shuffle a row per task, which the driver collects later
    for _ in range(20):
        if len(left()) <= counted:
            break
        time.sleep(0.5)
    assert len(left()) <= counted and spark.conf.get(REMOVE_SHUFFLES, None) == setting


def test_stored_tables_hold_what_cannot_be_derived(spark, sf_dir):
    t = fixtures.load_tables(spark, sf_dir)
    t.diaalert.count()
    t.broker_message.count()
    columns = lambda df: set(spark.read.parquet(df.inputFiles()[0].rsplit("/", 1)[0]).columns)
    assert not {"alert_id", "ps_flux_err"} & columns(t.diaalert)
    assert not {"broker_message_id", "alert_id", "ingest_ts"} & columns(t.broker_message)
