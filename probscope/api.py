"""User-facing entry points, one method per analysis a client of the original
service runs, all returning lazy Spark DataFrames over every classifier and true
class (filter the result, or pass ids, to narrow it).

    from probscope.api import Metrics
    m = Metrics.from_tables(load_tables(spark, "/data/sf1"))
    m.classifications("last_best", include_missed=True).show()
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probscope.functions import bins as B
from probscope.operators import catalog as cat
from probscope.operators import confusion as cm
from probscope.operators import diagnostics as dg
from probscope.operators import explore as ex
from probscope.operators import probdiff as pdiff
from probscope.operators import probhist as ph
from probscope.operators import relday as rd
from probscope.sources import io
from probscope.sources.fixtures import Tables


def _only(df: DataFrame, col: str, ids) -> DataFrame:
    if ids is None:
        return df
    ids = [ids] if isinstance(ids, int) else list(ids)
    return df.where(F.col(col).isin(ids))


class Metrics:
    """Metrics over one set of domain tables."""

    # fixed bin settings, as properties of the original client
    tbin_min, tbin_max, tbin_num = B.TBINS.lo, B.TBINS.hi, B.TBINS.n
    probbin_min, probbin_max, probbin_num = B.PROBBINS.lo, B.PROBBINS.hi, B.PROBBINS.n

    def __init__(self, tables: Tables):
        self.t = tables
        self._probhist: DataFrame | None = None

    @classmethod
    def from_tables(cls, tables: Tables) -> Metrics:
        return cls(tables)

    # ---- catalogues
    def classname(self) -> DataFrame:
        """(class_id, description): one description per class."""
        return cat.class_catalog(self.t).select("class_id", "description")

    def taxonomy(self) -> DataFrame:
        """Classes in taxonomy order (``sort_key``), 'missed' (-1) first."""
        return cat.taxonomy_order(self.t)

    def classifier_info(self) -> DataFrame:
        return cat.classifier_catalog(self.t)

    # ---- confusion matrices
    def classifications(self, definition: str = "last_best", nth_detection: int = 3,
                        classifier_id: int | Sequence[int] | None = None, include_missed: bool = False) -> DataFrame:
        """(pred_class, true_class, n, classifier_id, classifier_name); missed = -1."""
        ids = [classifier_id] if isinstance(classifier_id, int) else classifier_id
        counts = cm.confusion_counts(self.t, definition, nth_detection, include_missed, ids)
        return cm.with_classifier_name(counts, self.t.classifiers).select(
            "pred_class", "true_class", "n", "classifier_id", "classifier_name")

    def conf_matrix(self, counts: DataFrame, norm: str = "true") -> DataFrame:
        """Dense, normalised, annotated matrix of ``classifications(...)`` output."""
        dense = cm.normalize(cm.densify(counts.select("classifier_id", "pred_class", "true_class", "n")), norm)
        return cm.with_classifier_name(cm.annotate(dense, cm.class_names(self.t.gentype_hier)), self.t.classifiers)

    # ---- probability histogram
    def probhist(self) -> DataFrame:
        """The (tiny, aggregated) histogram, computed once per ``Metrics`` and kept with
        ``persist(MEMORY_AND_DISK)``; lost blocks are recomputed from lineage."""
        if self._probhist is None:
            from pyspark import StorageLevel
            self._probhist = ph.probhist(self.t).persist(StorageLevel.MEMORY_AND_DISK)
        return self._probhist

    def release(self) -> None:
        if self._probhist is not None:
            self._probhist.unpersist()
            self._probhist = None

    @staticmethod
    def tbin_val(b) -> Column:
        return B.tbin_val(b)

    @staticmethod
    def probbin_val(b) -> Column:
        return B.probbin_val(b)

    @staticmethod
    def tbin_label(b) -> Column:
        """Axis label of a time bin ('<-30.0', centre, '≥100.0')."""
        return B.tbin_label(b)

    def expected_probability(self, classifier_id=None, true_class_id=None) -> DataFrame:
        hist = _only(_only(self.probhist(), "classifier_id", classifier_id), "true_class_id", true_class_id)
        return ph.expected_probability(hist)

    def violin_table(self, tbins=(5, 7, 13, 19, 27)) -> DataFrame:
        return ph.violin_table(self.probhist(), self.t.confusion_classes, tbins)

    # ---- probability differences
    def right_probdiffs_for_object(self, dia_object_id: int) -> DataFrame:
        objs = self.t.truth.where(F.col("dia_object_id") == dia_object_id).select("dia_object_id")
        return pdiff.probdiff_for_objects(self.t, objs)

    def right_probdiffs_hist(self) -> DataFrame:
        return pdiff.probdiff_hist(self.t)

    def right_probdiffs_hist_filled(self) -> DataFrame:
        return pdiff.zero_fill(self.right_probdiffs_hist())

    @staticmethod
    def right_probdiffs_hist_probbin_mean(b) -> Column:
        return B.probdiff_bin_mean(b)

    # ---- per-day summaries (the cached summaries of the original service)
    def _of(self, operator, classifier_id, true_class_id) -> DataFrame:
        """``operator`` over the objects of one true class and the rows of one classifier, if given: both
        filters reach the scans."""
        t = self.t
        if true_class_id is not None and t.context is None:
            gentypes = t.gentype.where(F.col("class_id") == true_class_id).select("gentype")
            t = t.but(truth=t.truth.join(gentypes, "gentype", "left_semi").select(*t.truth.columns))
        if classifier_id is not None:
            only = {n: _only(getattr(t, n), "classifier_id", classifier_id)
                    for n in ("broker_classification", "message_probs") if getattr(t, n) is not None}
            t = t.but(**only)
        return _only(_only(operator(t), "classifier_id", classifier_id), "true_class_id", true_class_id)

    def mean_probabilities(self, classifier_id=None, true_class_id=None) -> DataFrame:
        return self._of(rd.prob_by_relday, classifier_id, true_class_id).drop("max_probability")

    def max_probabilities(self, classifier_id=None, true_class_id=None) -> DataFrame:
        return self._of(rd.prob_by_relday, classifier_id, true_class_id).drop("mean_probability")

    def objects(self, classifier_id=None, true_class_id=None) -> DataFrame:
        return self._of(rd.object_summary, classifier_id, true_class_id)

    def sources(self, classifier_id=None, true_class_id=None) -> DataFrame:
        return self._of(rd.source_summary, classifier_id, true_class_id)

    def classifications_with_relday(self, classifier_id=None, true_class_id=None) -> DataFrame:
        return self._of(rd.classification_rows, classifier_id, true_class_id)

    def top_class_curves(self, classifier_id=None, true_class_id=None, k: int = 5) -> DataFrame:
        return rd.top_class_curves(self._of(rd.prob_by_relday, classifier_id, true_class_id), k)

    def relday_distribution(self, classifier_id=None, true_class_id=None) -> DataFrame:
        return self._of(rd.relday_distribution, classifier_id, true_class_id)

    def peak_confusion_column(self, band: str = "r") -> DataFrame:
        return rd.peak_confusion_column(self.t, band)

    def write_summary(self, df: DataFrame, path: str) -> str:
        """Materialise a per-(classifier, true class) summary as partitioned Parquet."""
        return io.write_summary(df, path)

    # ---- exploration and diagnostics
    def light_curve(self, dia_object_id: int) -> DataFrame:
        objs = self.t.truth.where(F.col("dia_object_id") == dia_object_id).select("dia_object_id")
        return ex.light_curve(self.t, objs)

    def object_prob_history(self, dia_object_id: int) -> DataFrame:
        objs = self.t.truth.where(F.col("dia_object_id") == dia_object_id).select("dia_object_id")
        return ex.object_prob_history(self.t, objs)

    def classifications_with_deltat(self, classifiers: DataFrame, true_class_id: int, limit: int | None = None) -> DataFrame:
        return ex.classifications_with_deltat(self.t, classifiers, true_class_id, limit)

    def prob_matrix(self, dia_object_id: int) -> DataFrame:
        """deltat x class matrix of one object's rounded probabilities, per classifier."""
        rows = rd.all_rows_with_relday(self.t).where(F.col("dia_object_id") == dia_object_id)
        return ex.prob_matrix(rows, ex.catalogue_classes(self.t))

    def totprob_audit(self) -> DataFrame:
        return ph.totprob_audit(ph.totprob_per_source(self.t))

    def richest_object(self, classifier_id: int = 1, rank: int = 3) -> DataFrame:
        return ex.richest_object(self.t, classifier_id, rank)

    def alert_rate(self, every: str = "1 day") -> DataFrame:
        return dg.alert_rate(self.t, every)

    def completeness(self) -> DataFrame:
        return dg.completeness(self.t)

    def run_query(self, text: str, subdict: dict | None = None, **frames: DataFrame) -> DataFrame:
        """Parameterised SQL (``:name`` markers bound by the engine)."""
        return io.run_sql(self.t.truth.sparkSession, text, subdict, **frames)
