"""Work and state that grow with what a query reads: tables on demand, joins by message."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from probscope.operators import diagnostics as dg
from probscope.operators import probdiff as pd
from probscope.operators import probhist as ph
from probscope.operators import relday as rd
from probscope.operators.context import classified_sources, source_classifications
from probscope.plans import incremental as inc
from probscope.plans.registry import finish
from probscope.sources.fixtures import FILTER_OF_FLAG, flag_place, load_tables


def rows(df):
    df = finish(df)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_are_written_when_first_read(spark, sf_dir, tmp_path):
    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    t = load_tables(spark, str(tmp_path)).but(context=None)
    t.truth.count()
    t.diaalert.count()
    t.diasource.count()
    base = os.path.dirname(t.truth.inputFiles()[0].removeprefix("file://")) + "/.."
    assert sorted(os.listdir(base)) == ["_sources", "truth"]
    assert sorted(os.listdir(os.path.dirname(t.paths["truth"]))) == sorted([*t.paths, "_sources", "_messages"])
    whole = load_tables(spark, sf_dir)
    assert all(rows(getattr(t, n)) == rows(getattr(whole, n)) for n in t.paths if n != "message_probs")
    assert load_tables(spark, str(tmp_path), materialize=False).broker_classification.exceptAll(t.broker_classification).isEmpty()


BY_MESSAGE = {
    "classification_summary": rd.classification_summary,
    "relday_distribution": rd.relday_distribution,
    "probdiff_hist": pd.probdiff_hist,
    "probhist": ph.probhist,
    "prob_by_detection": dg.prob_by_detection,
    "source_classifications": source_classifications,
    "classified_sources": classified_sources,
    **{f"partial of {n}": s.partial for n, s in inc.SUMMARIES.items()},
}


@pytest.mark.parametrize("name", sorted(BY_MESSAGE))
def test_classifications_are_joined_by_message(tables, name):
    """No scan of the long rows where the arrays are stored, and the same result without them."""
    with_arrays = BY_MESSAGE[name](tables)
    assert "probability#" not in "".join(x for x in plan(with_arrays).splitlines() if "FileScan" in x)
    assert not any("ReadSchema" in x and "class_id:int" in x and "probs:" not in x for x in plan(with_arrays).splitlines())
    without = BY_MESSAGE[name](dataclasses.replace(tables, message_probs=None)).select(*with_arrays.columns)
    assert rows(with_arrays.drop("first")) == rows(without.drop("first"))


def test_flags_keep_their_order_as_numbers(spark):
    texts = ["", "A", "AA", "B", "M", "N", "Na", "Q", "R", "RR", "S", "é", None]
    df = spark.createDataFrame([(k, a) for k, pair in enumerate((a, b) for a in texts for b in texts) for a in pair],
                               "k int, l_returnflag string")
    flags = sorted(FILTER_OF_FLAG)
    found = df.groupBy("k").agg(F.min("l_returnflag").alias("least"), F.min(flag_place("l_returnflag", flags)).alias("place"))
    for r in found.collect():
        assert (None if r.place is None or r.place % 2 == 0 else flags[r.place // 2]) == (r.least if r.least in flags else None)


def test_sources_are_hashed_not_sorted(spark, sf_dir):
    t = load_tables(spark, sf_dir, materialize=False)
    assert "SortAggregate" not in plan(t.diasource)


def test_messages_meet_alerts_with_their_sources(tables):
    joined = ph.message_source_context(tables.but(context=None))._jdf.queryExecution().optimizedPlan().toString()
    assert "(alert_id#" in next(x for x in joined.splitlines() if "Join Inner" in x)


def test_differences_are_compiled(spark):
    rows_ = [(1, 7, 1, b, float(b)) for b in (3, 1, 2)] + [(1, 7, 2, 1, 0.5), (1, 7, 3, 1, None), (1, 7, 3, 4, 0.25)]
    found = pd.probdiff(spark.createDataFrame(
        rows_, "classifier_id int, true_class_id int, dia_object_id long, timebin int, maxprob double"))
    assert "lambda" not in plan(found)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, 7, 1, 1, 2, 1.0), (1, 7, 1, 1, 3, 2.0), (1, 7, 1, 2, 3, 1.0), (1, 7, 3, 1, 4, None)], key=repr)


def test_a_lone_message_is_its_own_mean(spark, tables):
    """No aggregate over the classes of messages that are alone with their classifier and source; the others, a class
    listed twice and numbers out of the ordinary are averaged as from the long rows."""
    source = tables.diasource.join(tables.truth, "dia_object_id").join(tables.diaalert, ["dia_source_id", "dia_object_id"])
    alerts = [r.alert_id for r in source.select("alert_id").distinct().orderBy("alert_id").limit(3).collect()]
    probs = {1: [(10, 0.1), (20, -0.0)], 2: [(10, None), (20, float("nan"))], 3: [(10, 0.25), (10, 0.5), (None, 0.3)],
             4: [(10, 0.1)], 5: [(10, 0.2), (20, 5e9)], 6: []}
    alert = {1: 0, 2: 1, 3: 2, 4: 0, 5: 0, 6: 1}
    classifier = {1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3}
    t = tables.but(
        broker_message=spark.createDataFrame([(m, alerts[a]) for m, a in alert.items()], "broker_message_id long, alert_id long")
        .withColumn("ingest_ts", F.current_timestamp()),
        message_probs=spark.createDataFrame([(m, classifier[m], p) for m, p in probs.items()],
                                            "broker_message_id long, classifier_id int, "
                                            "probs array<struct<class_id:int, probability:double>>"), context=None)
    t.broker_classification = t.message_probs.select("broker_message_id", "classifier_id", F.inline("probs"))
    found = ph.dedupe_mean(t)
    averaged = ph.dedupe_mean(t.but(message_probs=None)).select(*found.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, averaged.collect()))
    assert found.count() == 8
    assert "Window" in plan(ph.dedupe_mean(t))


def test_sums_that_fit_a_long_equal_those_of_decimals(spark):
    from decimal import Decimal
    from probscope.functions import exact as X
    pairs = [(h, l) for h in (0, -1, 1, 2**30, 2**30 + 1, -2**30 - 1, 2**62) for l in (0, 1, -7, 2**61, 2**61 + 1, 2**62)]
    df = spark.createDataFrame([(h, l, float(h * 2**31 + l) / X.UNITS) for h, l in pairs], "h long, l long, x double")
    assert df.select(X.total(F.col("h"), F.col("l"), F.lit(0.0)).alias("t"), "x").where("t <> x").isEmpty()
    assert Decimal(2**30 * 2**31 + 2**61) < 2**63


def test_true_class_rows_are_joined_by_message_last(tables):
    from probscope.operators import explore as ex
    found = ex.true_class_rows(tables)
    joined = found._jdf.queryExecution().optimizedPlan().toString()
    assert "(broker_message_id#" in next(x for x in joined.splitlines() if "Join Inner" in x)
    view = source_classifications(tables).where(F.col("class_id") == F.col("true_class_id"))
    plain = (view.join(tables.diasource.select("dia_source_id", "mid_point_tai"), "dia_source_id")
             .join(tables.truth.select("dia_object_id", "peakmjd"), "dia_object_id")
             .withColumn("deltat", F.col("mid_point_tai") - F.col("peakmjd")).select(*found.columns))
    assert rows(found) == rows(plain)


def test_arrays_are_joined_as_numbers(tables):
    joined = rd.relday_distribution(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "probs#" in joined and "class_ids#" in joined
    assert not any("Generate" in x and "probs#" in x for x in joined.splitlines())


def test_messages_are_stored_once(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    assert "/_messages/" in t.broker_message.inputFiles()[0]
    assert rows(t.broker_message) == rows(load_tables(spark, sf_dir, materialize=False).broker_message)
