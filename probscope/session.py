"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Spark's setting that removes the files of an action's shuffles when the action ends (4.1; unknown to older ones).
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "probscope") -> SparkSession:
    """Local session used by tests and bench (a cluster passes its own session)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, what an action shuffles is removed when the action ends, not when the driver happens to collect its
    garbage. For what is written and read back; a frame that is computed twice is shuffled twice."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage; we
    only read it. Where it is unset and the master is local (unit tests on a laptop) a
    local folder is chosen and registered; on a cluster, whose executors would each
    write to their own disk, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not root and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="probscope-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def join_path(root: str, *parts: str) -> str:
    if "://" in root:
        return "/".join([root.rstrip("/"), *parts])
    return os.path.join(root, *parts)
