"""Physical-plan checks: no Python UDFs, no cartesian products, map-side top-1,
pushed-down filters, partial top-n before the shuffle."""

import pytest

from probscope.operators import confusion as cm
from probscope.plans.registry import queries


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_udf_no_cartesian(spark, sf_dir, name):
    if name in ("alert_rate_stream", "summary_partition_roundtrip", "csv_roundtrip"):
        pytest.skip("plan is a read of files written by the query")
    plan = _plan(queries()[name](spark, sf_dir))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan


def test_pick_one_is_an_aggregate_not_a_sort(tables):
    plan = _plan(cm.chosen_classification(tables, "last_best"))
    assert "max_by" in plan
    assert "Window" not in plan


def test_nth_detection_uses_group_limit(tables):
    plan = tables.diasource.sparkSession  # noqa: F841
    df = cm.nth_detection_sources(tables, 3)
    assert "WindowGroupLimit" in _plan(df)


def test_filters_reach_the_scan(tables):
    from pyspark.sql import functions as F
    df = (tables.broker_classification.where((F.col("classifier_id") == 1) & (F.col("probability") > 0.5))
          .select("class_id"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(classifier_id), IsNotNull(probability)" in plan
    assert "classifier_id,1)" in plan  # the equality itself (the plan text truncates long lists)
    assert "ReadSchema: struct<classifier_id:int,class_id:int,probability:double>" in plan


def test_summary_read_prunes_partitions(spark, tables):
    import uuid

    from probscope.operators import relday as rd
    from probscope.sources import io
    path = io.scratch_path(spark, "test-summary", uuid.uuid4().hex[:8])
    io.write_summary(rd.prob_by_relday(tables), path)
    one = io.read_summary(spark, path, classifier_id=2, true_class_id=2223)
    plan = _plan(one)
    assert "PartitionFilters: [isnotnull(classifier_id" in plan
    assert one.select("classifier_id", "true_class_id").distinct().collect() == [(2, 2223)]
    full = rd.prob_by_relday(tables).where("classifier_id = 2 AND true_class_id = 2223")
    assert one.count() == full.count()


def test_detection_ordinals_rank_within_day_buckets(tables):
    from probscope.operators.diagnostics import detection_ordinals
    import re
    plan = _plan(detection_ordinals(tables))
    specs = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*)", plan)
    assert specs and all(re.match(r"dia_object_id#\d+L?, bucket#\d+L?, ", s) for s in specs)  # never object-wide


def test_pairing_is_not_a_self_join(tables):
    from probscope.operators import probdiff as pdiff
    plan = _plan(pdiff.probdiff(pdiff.max_prob_by_timebin(tables)))
    assert "collect_list" in plan and "SortMergeJoin" in plan  # the only SMJ is classification x context
    assert plan.count("SortMergeJoin") == 1


def test_missed_objects_single_aggregate_no_product(tables):
    plan = _plan(cm.confusion_counts(tables, include_missed=True))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Union" in plan and "Subquery" in plan  # signed union + scalar catalogue subquery


def test_bucketed_tables_skip_the_shuffle(spark, tables):
    import re
    import uuid

    from pyspark.sql import functions as F

    from probscope.sources import io
    run = uuid.uuid4().hex[:8]
    cls = io.write_bucketed(tables.broker_classification, f"cls_{run}", io.scratch_path(spark, "bk", run, "c"), buckets=8)
    msg = io.write_bucketed(tables.broker_message, f"msg_{run}", io.scratch_path(spark, "bk", run, "m"), buckets=8)
    per_msg = cls.groupBy("broker_message_id", "classifier_id").agg(F.max("probability").alias("p"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(per_msg.join(msg, "broker_message_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 0


def test_stored_arrays_need_no_shuffle(tables):
    from probscope.operators.reshape import per_message_argmax
    plan = _plan(per_message_argmax(tables))
    assert "Exchange" not in plan and "Sort" not in plan and "probs#" in plan


def test_arrays_and_long_rows_agree(tables):
    import dataclasses

    from probscope.operators import relday as rd
    from probscope.operators.reshape import per_message_argmax
    plain = dataclasses.replace(tables, message_probs=None)
    for f in (per_message_argmax, rd.latest_message_rows):
        a, b = f(tables), f(plain).select(*f(tables).columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_latest_messages_read_the_classifications_once(tables):
    from probscope.operators import relday as rd
    plan = _plan(rd.latest_message_rows(tables))
    assert plan.count("probs") > 0 and "broker_classification" not in plan


def test_object_filter_reaches_both_scans(tables):
    from pyspark.sql import functions as F

    from probscope.operators.probhist import message_source_context
    plan = _plan(message_source_context(tables).where(F.col("dia_object_id") == 32))
    scans = [x for x in plan.splitlines() if "FileScan" in x and "dia_source_id" in x]  # alerts and sources
    assert len(scans) == 2 and all("EqualTo(dia_object_id,32)" in x for x in scans), scans


def test_quantiles_shuffle_only_the_bins_asked_for(spark, tables):
    """What is asked for is sent to the rows, whatever Spark would broadcast by itself."""
    from pyspark.sql import functions as F

    from probscope.operators.quantiles import exact_quantiles
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") / 1000).alias("v"))
        found = exact_quantiles(rows, ["k"], "v", {"q50": 0.5}, F.floor(F.col("v") * 10), few_groups=True)
        assert "SortMergeJoin" not in _plan(found) and "BroadcastHashJoin" in _plan(found)
        plain = exact_quantiles(rows, ["k"], "v", {"q50": 0.5}, F.floor(F.col("v") * 10))
        assert sorted(found.collect()) == sorted(plain.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_argmax_of_a_message_is_compiled(spark):
    """Messages with one greatest number skip the interpreted functions; NULLs, NaN, ties and the number that
    stands for none come out the same."""
    from probscope.operators.reshape import NO_PROBABILITY, argmax_from_array
    nan = float("nan")
    rows = [(1, [(5, .2), (7, .9), (9, .9)], 7, .9), (2, [(5, None), (7, .9)], 5, None), (3, [(9, .9), (7, .9), (5, .1)], 7, .9),
            (4, [(3, nan), (4, 1.)], 3, nan), (5, [(3, nan), (2, nan)], 2, nan), (6, [(3, None), (2, None)], 2, None),
            (7, [(3, NO_PROBABILITY), (2, 2 * NO_PROBABILITY)], 3, NO_PROBABILITY), (8, [(None, .4), (2, .3)], None, .4),
            (9, [(5, 0.0), (3, -0.0)], 3, -0.0), (10, [(1, .1), (2, .8), (3, .7)], 2, .8)]
    schema = "broker_message_id long, classifier_id int, probs array<struct<class_id:int,probability:double>>"
    msgs = spark.createDataFrame([(i, 1, p) for i, p, _, _ in rows] + [(11, 1, []), (12, 1, None)], schema)
    found = argmax_from_array(msgs)
    assert "array_position" in _plan(found)
    assert {r.broker_message_id: (r.class_id, repr(r.probability)) for r in found.collect()} == {
        i: (c, repr(p)) for i, _, c, p in rows}


def test_stream_messages_land_in_more_files_than_epochs(spark, tables, monkeypatch):
    """All tasks write the messages; an epoch still takes a third of them."""
    from probscope.plans import added_queries as aq
    seen = []

    class Stop(Exception):
        pass

    def stop(t, path, *args, files_per_epoch=None, **kw):
        files = len(spark.read.parquet(path).inputFiles())
        seen.append((files, -(-files // files_per_epoch)))
        raise Stop

    monkeypatch.setattr(aq, "start_summaries", stop)
    with pytest.raises(Stop):
        aq.relday_mean_stream(tables)
    assert seen[0][0] > 3 and seen[0][1] == 3
