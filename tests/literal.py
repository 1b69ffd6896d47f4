"""Build a small ``Tables`` from literal rows (edge-case tests)."""

from datetime import datetime

from probscope import schemas as S
from probscope.sources import dims
from probscope.sources.fixtures import Tables


def ts(day: int, sec: int = 0):
    return datetime(2024, 1, day, 0, 0, sec)


def make_tables(spark, truth, sources, alerts, messages, classifications, gentype=None, classifiers=None):
    """truth: (obj, gentype, peak); sources: (src, obj, mpt, filter); alerts: (alert, src, obj, ts);
    messages: (msg, alert, ingest_ts); classifications: (msg, classifier, class, p)."""
    src_rows = [(s, o, m, 1.0, 0.05, f) for s, o, m, f in sources]
    return Tables(
        truth=spark.createDataFrame(truth, S.DIAOBJECT_TRUTH),
        diasource=spark.createDataFrame(src_rows, S.DIASOURCE),
        diaforcedsource=spark.createDataFrame([r[1:] for r in src_rows], S.DIAFORCEDSOURCE),
        diaalert=spark.createDataFrame(alerts, S.DIAALERT),
        broker_message=spark.createDataFrame([(m, a, t, t) for m, a, t in messages], S.BROKER_MESSAGE),
        broker_classification=spark.createDataFrame(classifications, S.BROKER_CLASSIFICATION),
        gentype=spark.createDataFrame(gentype or dims.EXACT_CLASSES, S.GENTYPE_OF_CLASSID),
        gentype_hier=spark.createDataFrame(dims.EXACT_CLASSES + dims.HIER_EXTRA_CLASSES, S.GENTYPE_OF_CLASSID),
        classifiers=spark.createDataFrame(classifiers or dims.CLASSIFIERS, S.BROKER_CLASSIFIER),
        timebins=dims.maxprob_timebins(spark),
        confusion_classes=dims.confusion_classes(spark),
    )
