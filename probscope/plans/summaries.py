"""Batch job: build the per-(classifier, true class) summaries as Parquet tables.

This is the refresh of the precomputed views a metrics service serves: each
summary is computed from the domain tables in one Spark plan and written
partitioned by ``classifier_id`` / ``true_class_id`` (confusion matrices by
``classifier_id``), so a reader asking for one classifier and true class
touches one folder. Every write goes through Spark's commit protocol, so a lost
executor only re-runs tasks; a failed summary can be rebuilt on its own.

    spark-submit -m probscope.plans.summaries <tables_root> <out_root>
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from probscope.operators import confusion as cm
from probscope.operators import probdiff as pdiff
from probscope.operators import probhist as ph
from probscope.operators import relday as rd
from probscope.sources import io
from probscope.sources.fixtures import Tables

SUMMARIES: dict[str, tuple[Callable[[Tables], DataFrame], tuple[str, ...]]] = {
    "probhist": (ph.probhist, io.SUMMARY_PARTITIONS),
    "probdiff_hist": (pdiff.probdiff_hist, io.SUMMARY_PARTITIONS),
    "relday_probabilities": (rd.prob_by_relday, io.SUMMARY_PARTITIONS),
    "relday_distribution": (rd.relday_distribution, io.SUMMARY_PARTITIONS),
    "peak_confusion_column": (rd.peak_confusion_column, io.SUMMARY_PARTITIONS),
    "objects": (rd.object_summary, io.SUMMARY_PARTITIONS),
    "sources": (rd.source_summary, io.SUMMARY_PARTITIONS),
    "classifications": (rd.classification_rows, io.SUMMARY_PARTITIONS),
    "confusion_last_best": (lambda t: cm.with_classifier_name(
        cm.confusion_counts(t, "last_best", include_missed=True), t.classifiers), ("classifier_id",)),
    "confusion_best": (lambda t: cm.with_classifier_name(
        cm.confusion_counts(t, "best", include_missed=True), t.classifiers), ("classifier_id",)),
}


#: Summaries of about as many rows as the sources or classifications.
LARGE = {"objects", "sources", "classifications"}


def build_summaries(tables: Tables, out_root: str, names=None, share_context: bool = True) -> dict[str, str]:
    """Write the chosen summaries under ``out_root``; returns name -> path.

    With ``share_context`` the message-grain context (message -> alert -> source ->
    truth, three large joins) is written once under ``out_root/_context`` and every
    summary reads it: the lineage is cut on shared storage, and a lost executor
    later in the run re-reads files instead of redoing the joins."""
    written = {}
    if share_context:
        spark = tables.truth.sparkSession
        ctx_path = io.join_path(out_root, "_context")
        ph.message_source_context(tables).write.mode("overwrite").parquet(ctx_path)
        tables = tables.but(context=spark.read.parquet(ctx_path))
        written["_context"] = ctx_path
    for name in names or SUMMARIES:
        fn, parts = SUMMARIES[name]
        written[name] = io.write_summary(fn(tables), io.join_path(out_root, name), parts, large=name in LARGE)
    return written


def main(argv: list[str]) -> None:
    tables_root, out_root = argv[1], argv[2]
    spark = SparkSession.builder.appName("probscope-summaries").getOrCreate()
    build_summaries(io.read_tables(spark, tables_root), out_root)


if __name__ == "__main__":
    main(sys.argv)
