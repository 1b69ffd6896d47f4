import uuid

from pyspark.sql import functions as F

from probscope.operators import relday as rd
from probscope.plans.summaries import build_summaries
from probscope.sources import io


def test_read_tables_roundtrip_and_summaries(spark, tables):
    root = tables.paths["truth"].rsplit("/", 1)[0]
    catalogues = {n: getattr(tables, n) for n in io.DIM_TABLES}
    t2 = io.read_tables(spark, root, catalogues, arrays=True)
    assert t2.broker_classification.count() == tables.broker_classification.count()
    out = io.scratch_path(spark, "test-summaries", uuid.uuid4().hex[:8])
    paths = build_summaries(t2, out, ["relday_probabilities", "confusion_last_best", "classifications"])
    back = io.read_summary(spark, paths["relday_probabilities"], classifier_id=1, true_class_id=2222)
    want = rd.prob_by_relday(tables).where("classifier_id = 1 AND true_class_id = 2222")
    cols = ["relday", "class_id", "n"]
    assert sorted(back.select(*cols).collect()) == sorted(want.select(*cols).collect())
    rows = io.read_summary(spark, paths["classifications"], classifier_id=1)
    assert rows.count() == rd.classification_rows(tables).where("classifier_id = 1").count()
    conf = spark.read.parquet(paths["confusion_last_best"])
    assert conf.where(F.col("pred_class") == -1).count() > 0


def test_shared_context_gives_same_summaries(spark, tables):
    out = io.scratch_path(spark, "test-summaries-ctx", uuid.uuid4().hex[:8])
    shared = build_summaries(tables, out + "/a", ["probhist", "peak_confusion_column"], share_context=True)
    plain = build_summaries(tables, out + "/b", ["probhist", "peak_confusion_column"], share_context=False)
    assert "_context" in shared and "_context" not in plain
    for name in ("probhist", "peak_confusion_column"):
        a = spark.read.parquet(shared[name])
        b = spark.read.parquet(plain[name])
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
