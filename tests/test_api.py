from pyspark.sql import functions as F

from probscope.api import Metrics


def test_facade_matches_operators(tables):
    m = Metrics.from_tables(tables)
    a = m.classifications("last_best", classifier_id=2).collect()
    assert a and all(r.classifier_id == 2 for r in a)
    missed = m.classifications("best", include_missed=True)
    mat = m.conf_matrix(missed, "pred")
    assert "classifier_name" in mat.columns
    sums = mat.groupBy("classifier_id", "pred_class").agg(F.sum("fraction").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in sums)
    assert m.mean_probabilities(classifier_id=1, true_class_id=2222).select("classifier_id").distinct().count() == 1
    obj = tables.truth.select(F.min("dia_object_id")).first()[0]
    assert m.light_curve(obj).select("dia_object_id").distinct().count() <= 1
    assert m.right_probdiffs_hist().count() > 0
    assert m.classname().count() >= 5
    rows = m.run_query("SELECT count(*) AS n FROM {c} WHERE classifier_id = :k", {"k": 1},
                       c=tables.broker_classification).first().n
    assert rows == tables.broker_classification.where("classifier_id = 1").count()


def test_point_queries_equal_filtered_whole_table(tables):
    from probscope.operators import probdiff as pdiff
    m = Metrics.from_tables(tables)
    obj = (pdiff.probdiff(pdiff.max_prob_by_timebin(tables)).groupBy("dia_object_id").count()
           .orderBy(F.desc("count"), "dia_object_id").first().dia_object_id)
    one = m.right_probdiffs_for_object(obj).select("classifier_id", "earlytimebin", "latetimebin", "probdiff")
    whole = (pdiff.probdiff(pdiff.max_prob_by_timebin(tables)).where(F.col("dia_object_id") == obj)
             .select("classifier_id", "earlytimebin", "latetimebin", "probdiff"))
    assert one.count() > 0 and one.exceptAll(whole).count() == 0 and whole.exceptAll(one).count() == 0
    lc = m.light_curve(obj)
    assert lc.count() == tables.diaforcedsource.where(F.col("dia_object_id") == obj).count()


def test_listings_by_classifier_and_class(tables):
    m = Metrics.from_tables(tables)
    for method in (m.objects, m.sources, m.classifications_with_relday, m.mean_probabilities, m.top_class_curves):
        whole = method().where("classifier_id = 1 AND true_class_id = 2223")
        one = method(classifier_id=1, true_class_id=2223)
        assert one.columns == whole.columns and one.count() == whole.count() > 0
        assert one.exceptAll(whole).count() == 0


def test_histogram_is_kept(tables):
    m = Metrics.from_tables(tables)
    first = m.probhist()
    assert m.probhist() is first and first.is_cached
    m.release()
    assert not first.is_cached


def test_more_analyses_run(tables):
    m = Metrics.from_tables(tables)
    obj = m.richest_object().first().dia_object_id
    assert m.prob_matrix(obj).count() > 0 and m.totprob_audit().count() == 4
    assert m.classifications_with_deltat(tables.classifiers, 2222, limit=7).count() == 7
    assert m.right_probdiffs_hist_filled().count() % 41 == 0 and m.relday_distribution(1).count() > 0
