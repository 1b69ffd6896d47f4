"""Summaries kept batch by batch equal a rebuild, whatever is delivered twice, empty, out of order or half written."""

import dataclasses

import pytest

from probscope.operators import confusion as cm
from probscope.operators import probdiff as pd
from probscope.operators import probhist as ph
from probscope.operators import relday as rd
from probscope.plans import incremental as inc
from probscope.plans.registry import finish
from probscope.sources import commits

PLAIN = {
    "probhist": ph.probhist,
    "confusion_last_best": lambda t: cm.with_classifier_name(cm.confusion_counts(t, "last_best"), t.classifiers),
    "confusion_best": lambda t: cm.with_classifier_name(cm.confusion_counts(t, "best"), t.classifiers),
    "probdiff_hist": pd.probdiff_hist,
    "mean_prob_by_relday": lambda t: rd.prob_by_relday(t).drop("max_probability"),
    "relday_distribution": rd.relday_distribution,
}


def rows(df):
    df = finish(df)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def upto(t, batches):
    """The tables with the messages of ``batches`` alone."""
    messages = batches[0].broker_message
    for b in batches[1:]:
        messages = messages.union(b.broker_message)
    return dataclasses.replace(t, broker_message=messages)


def test_all_are_kept():
    assert set(PLAIN) == set(inc.SUMMARIES)


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_batches_equal_a_rebuild(spark, tables, tmp_path, name):
    root = str(tmp_path / "kept")
    one, two, three = inc.by_ingest_time(tables, 3)
    empty = dataclasses.replace(tables, broker_message=tables.broker_message.limit(0))
    assert inc.commit(three, root, 3, [name]) == [name]  # out of order
    assert rows(inc.read(tables, root, name)) == rows(PLAIN[name](three))
    assert inc.commit(empty, root, 0, [name]) == [name]
    assert inc.commit(one, root, 1, [name]) == [name]
    assert rows(inc.read(tables, root, name)) == rows(PLAIN[name](upto(tables, [one, three])))
    assert inc.commit(one, root, 1, [name]) == []  # delivered again
    assert inc.commit(two, root, 2, [name]) == [name]
    want = rows(PLAIN[name](tables))
    assert rows(inc.read(tables, root, name)) == want and len(want) > 50
    inc.compact(tables, root, name, str(tmp_path / "compact"), 3)
    assert rows(inc.read(tables, str(tmp_path / "compact"), name)) == want


def test_lost_writer(spark, tables, tmp_path, monkeypatch):
    """A driver lost before the log's row leaves the summary as it was, and the batch can be committed again."""
    root = str(tmp_path)
    one, two = inc.by_ingest_time(tables, 2)
    inc.commit(one, root, 1, ["probhist"])
    with monkeypatch.context() as m:
        m.setattr(commits, "record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            inc.commit(two, root, 2, ["probhist"])
    assert rows(inc.read(tables, root, "probhist")) == rows(ph.probhist(one))
    inc.commit(two, root, 2, ["probhist"])
    assert rows(inc.read(tables, root, "probhist")) == rows(ph.probhist(tables))


def test_only_ranges_of_days_that_a_batch_touches_are_read(spark, tables, tmp_path):
    """The state's scan is pruned to the batch's partitions."""
    root = str(tmp_path)
    inc.commit(tables, root, 1, ["probhist"])
    s = inc.SUMMARIES["probhist"]
    state = commits.committed(spark, f"{root}/probhist", "state", inc._ddl(s.merged(s.partial(tables))))
    plan = state.where("part in (70, 71)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan and state.select("part").distinct().count() > 5
    assert state.where("part in (70, 71)").count() < state.count()


def test_versions(spark, tmp_path):
    """The last commit of a batch counts; what is not in the log does not."""
    root = str(tmp_path)
    read = lambda: sorted(r.x for r in commits.committed(spark, root, "rows", "x long").collect())

    def put(batch_id, n, record=True):
        folder = commits.new_folder()
        spark.range(n).withColumnRenamed("id", "x").write.parquet(commits.folder_path(root, "rows", folder))
        if record:
            commits.record(spark, root, batch_id, folder)

    assert read() == [] and not commits.has(spark, root, 1)
    put(1, 2)
    put(2, 1)
    assert read() == [0, 0, 1] and commits.has(spark, root, 1)
    put(1, 5, record=False)
    assert read() == [0, 0, 1]
    put(1, 0)
    assert read() == [0]
    put(1, 3)
    assert read() == [0, 0, 1, 2]
