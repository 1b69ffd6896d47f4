"""Small literal dimensions (class catalogue, classifiers, time bins).

Every table here has a row count fixed by a Python list or a bin parameter, so
its size is proven and it is safe to broadcast. The catalogue tables stand in
for the server-side catalogue tables of the original service; on a cluster the
same schemas are read from Parquet instead (``sources.io``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probscope.schemas import (
    BROKER_CLASSIFIER,
    CONFUSION_CLASSES,
    GENTYPE_OF_CLASSID,
    MAXPROB_TIMEBINS,
)

# ---------------------------------------------------------------------------
# Fixed values (test fixture catalogue; see FIXTURES.md section 3).
# Exact-level classes with their simulation gentype and description.
# ---------------------------------------------------------------------------
EXACT_CLASSES = [
    (2222, 10, "SNIa"),
    (2223, 20, "SNIb/c"),
    (2224, 30, "SNII"),
    (2232, 40, "KN"),
    (2242, 50, "SLSN"),
    (2312, 60, "Pulsator A"),
    (2322, 70, "Pulsator/Other"),
    (3121, 80, "Lens"),
]
# Coarser taxonomy levels that the same gentypes fan out to, plus one repeated
# (class, description) pair so that "one description per class" is exercised.
HIER_EXTRA_CLASSES = [
    (2000, 10, "Variable"),
    (2200, 10, "Non-Recurring"),
    (2220, 10, "SN-like"),
    (2220, 20, "SN-like"),
    (2220, 30, "SN-like"),
    (2222, 12, "SNIa"),
    (2000, 60, "Variable"),
    (2300, 60, "Periodic"),
    (2300, 70, "Periodic"),
    (3100, 80, "Lens family"),
    (100, 0, "Residual"),
]
# Classifier catalogue: ids 1..4 have data, 5 has none; one NULL params value.
CLASSIFIERS = [
    (1, "Aster", "1.0", "RandomForest", "v1.2"),
    (2, "Aster", "1.0", "Transformer", None),
    (3, "Borealis", "2.1", "GBDT", "v3"),
    (4, "Cygnus", "0.9", "LightCurveNet", "v2.0"),
    (5, "Cygnus", "0.9", "Baseline", "v1"),
]
# Ordered class list used when the fixture builds one message into one row per class: exact classes in
# three hundreds and two thousands, and a meta class.
FIXTURE_CLASS_IDS = [2222, 2223, 2224, 2232, 2242, 2312, 2322, 3121, 100]
# Objects whose key leaves such a remainder have these gentypes instead of their priority's.
RARE_GENTYPES = [(13, 5, 60), (13, 7, 70), (17, 3, 80)]
# Max-probability time bins: (-99999, -20), ten-day bins up to 100, [100, 99999).
TIMEBIN_SENTINEL = 99999.0
TIMEBIN_EDGES = (-20.0, 100.0, 10.0)


def gentype_of_classid(spark: SparkSession, hierarchical: bool = False) -> DataFrame:
    rows = EXACT_CLASSES + (HIER_EXTRA_CLASSES if hierarchical else [])
    return F.broadcast(spark.createDataFrame(rows, GENTYPE_OF_CLASSID))


def broker_classifier(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(CLASSIFIERS, BROKER_CLASSIFIER))


def maxprob_timebins(spark: SparkSession, lo: float = TIMEBIN_EDGES[0], hi: float = TIMEBIN_EDGES[1],
                     width: float = TIMEBIN_EDGES[2], sentinel: float = TIMEBIN_SENTINEL) -> DataFrame:
    """Time-bin dimension: bin 1 below ``lo``, regular bins, last bin at/above ``hi``."""
    n = int(round((hi - lo) / width))
    rows = [(1, -sentinel, lo)]
    rows += [(k + 2, lo + width * k, lo + width * (k + 1)) for k in range(n)]
    rows.append((n + 2, hi, sentinel))
    return F.broadcast(spark.createDataFrame(rows, MAXPROB_TIMEBINS))


def confusion_classes(spark: SparkSession) -> DataFrame:
    """For each true class, the classes whose probability is shown next to it: itself and the next two."""
    true_ = [c for c, _, _ in EXACT_CLASSES]
    rows = [(t, true_[(i + k) % len(true_)]) for i, t in enumerate(true_) for k in range(3)]
    return F.broadcast(spark.createDataFrame(rows, CONFUSION_CLASSES))
