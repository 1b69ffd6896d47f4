"""Domain tables derived from the driver's TPC-H-like parquet (see FIXTURES.md).

``orders`` plays the truth table (one row = one object) and ``lineitem`` plays
the broker messages (one row = one message); sources, alerts and per-class
probabilities are computed from them with integer arithmetic that DuckDB can
repeat exactly (the oracle SQL in ``plans.oracle`` does so).

The derived tables are written once per Spark application to the shared
checkpoint folder (``spark.checkpoint.dir``) and read back as Parquet, which is
how a cluster would hold them: every query then starts from a pruned,
pushed-down Parquet scan instead of re-deriving its inputs.

A table is written when it is first asked for, so that a query pays for those that it reads. Sources, forced
sources and alerts are columns of one aggregate of ``lineitem`` and are read from one folder (``STORED``), and so are the
messages, which are grouped and numbered once for both tables that hold them. These folders hold what cannot be had
from their other columns; ids, errors and times that can are added when a table is read.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from probscope.session import checkpoint_root, join_path, shuffles_removed
from probscope.sources import dims

# Fixed values of the fixture formulas (FIXTURES.md section 2).
SOURCE_KEY_FACTOR = 10            # dia_source_id = orderkey * 10 + linenumber
MESSAGE_KEY_FACTOR = 1_000_000    # message id = source key * 1e6 + ordinal of the message within its source
DAY_PERIOD = 160                  # mid_point_tai = peak + posmod(ship - peak, 160) - 40
DAY_OFFSET = 40
FILTER_OF_FLAG = {"R": "r", "A": "g", "N": "i"}
TRUE_CLASS_BONUS = 40


class Later:
    """A field of ``Tables`` that is made when it is first read."""

    def __init__(self, make: Callable):
        self.make = make


@dataclass
class Tables:
    """The domain tables of one data set. A field may be given as ``Later``."""

    truth: DataFrame              # dia_object_id, gentype, peakmjd
    diasource: DataFrame          # dia_source_id, dia_object_id, mid_point_tai, ps_flux, ps_flux_err, filter_name
    diaforcedsource: DataFrame    # dia_object_id, mid_point_tai, ps_flux, ps_flux_err, filter_name
    diaalert: DataFrame           # alert_id, dia_source_id, dia_object_id, alert_sent_ts
    broker_message: DataFrame     # broker_message_id, alert_id, ingest_ts, broker_ts
    broker_classification: DataFrame  # broker_message_id, classifier_id, class_id, probability
    gentype: DataFrame            # class_id, gentype, description (exact level)
    gentype_hier: DataFrame       # the same plus coarser levels (fan-out)
    classifiers: DataFrame        # broker_classifier
    timebins: DataFrame           # timebin, dtmin, dtmax
    confusion_classes: DataFrame  # true_class_id, class_id
    paths: dict[str, str] | None = None  # Parquet folder of each data table, when materialised
    message_probs: DataFrame | None = None  # optional array form: broker_message_id, classifier_id, probs
    context: DataFrame | None = None      # optional precomputed message-grain context (see probhist)

    def __getattribute__(self, name):
        value = object.__getattribute__(self, name)
        if isinstance(value, Later):
            value = value.make()
            setattr(self, name, value)
        return value

    def but(self, **changes) -> Tables:
        """The same tables but for ``changes``; unlike ``dataclasses.replace`` it makes no table that waits."""
        return Tables(**(self.__dict__ | changes))


def _days(c: str) -> Column:
    """Whole days since 1970-01-01 of a timestamp column."""
    return F.unix_date(F.to_date(F.col(c))).cast("long")


def derive(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazily derive the six data tables, and the array form, from ``orders`` and ``lineitem``."""
    truth = _truth(spark, sf_dir)
    sources, messages = _whole_sources(_sources(spark, sf_dir, truth)), _whole_messages(_messages(spark, sf_dir))
    probs = _message_probs(messages, truth)
    return {
        "truth": truth,
        "diasource": sources.select(*SOURCE_COLUMNS),
        "diaforcedsource": sources.select(*SOURCE_COLUMNS[1:]),
        "diaalert": sources.select("alert_id", "dia_source_id", "dia_object_id", "alert_sent_ts"),
        "broker_message": messages.select("broker_message_id", "alert_id", "ingest_ts", "broker_ts"),
        "broker_classification": probs.select("broker_message_id", "classifier_id", F.inline("probs")),
        "message_probs": probs,
    }


SOURCE_COLUMNS = ["dia_source_id", "dia_object_id", "mid_point_tai", "ps_flux", "ps_flux_err", "filter_name"]


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("dia_object_id"),
        F.coalesce(*[F.when(F.col("o_orderkey") % m == r, g) for m, r, g in dims.RARE_GENTYPES],
                   F.substring("o_orderpriority", 1, 1).cast("int") * 10).alias("gentype"),
        _days("o_orderdate").cast("double").alias("peakmjd"),
    )


def _sources(spark: SparkSession, sf_dir: str, truth: DataFrame) -> DataFrame:
    """The columns of sources, forced sources and alerts, but for those that ``_whole_sources`` adds."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    flags = sorted(FILTER_OF_FLAG)
    filter_name = F.coalesce(*[F.when(F.col("rf") == 2 * k + 1, FILTER_OF_FLAG[f]) for k, f in enumerate(flags)])
    return (
        lineitem.groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_shipdate").alias("ship"), F.min("l_extendedprice").alias("ps_flux"),
             F.min(flag_place("l_returnflag", flags)).alias("rf"))
        .join(truth.select(F.col("dia_object_id").alias("l_orderkey"), "peakmjd"), "l_orderkey")
        .select(
            (F.col("l_orderkey") * SOURCE_KEY_FACTOR + F.col("l_linenumber")).alias("dia_source_id"),
            F.col("l_orderkey").alias("dia_object_id"),
            (F.col("peakmjd")
             + F.pmod(_days("ship") - F.col("peakmjd").cast("long"), F.lit(DAY_PERIOD)).cast("double")
             - float(DAY_OFFSET)).alias("mid_point_tai"),
            "ps_flux",
            filter_name.alias("filter_name"),
            "ship",
        )
        .select(
            "dia_source_id", "dia_object_id", "mid_point_tai", "ps_flux", "filter_name",
            F.when((F.col("dia_object_id") % 11 == 0) | (F.col("dia_source_id") % 7 == 0), F.lit(None))
            .otherwise(F.col("ship")).alias("alert_sent_ts"),
        )
    )


def _whole_sources(sources: DataFrame) -> DataFrame:
    return sources.withColumns({"ps_flux_err": F.lit(0.05) * F.col("ps_flux"), "alert_id": F.col("dia_source_id") + 1})


def flag_place(c: str, flags: list[str]) -> Column:
    """The place of a text among the sorted ``flags``: 2k + 1 for the k-th, an even number for a text before, between or
    behind them. Places keep the order of the texts, and a minimum of numbers is hashed where one of texts is sorted."""
    place = F.when(F.col(c) > flags[-1], 2 * len(flags))
    for k in reversed(range(len(flags))):
        place = F.when(F.col(c) < flags[k], 2 * k).when(F.col(c) == flags[k], 2 * k + 1).otherwise(place)
    return place


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per message with what the tables of messages are made from; ``_whole_messages`` adds the ids."""
    # dealt by source once: the rows of a message and the messages of a source then meet without another shuffle
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_discount", "l_tax", "l_quantity"
    ).repartition("l_orderkey", "l_linenumber")
    return (
        lineitem.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .agg(F.min("l_shipdate").alias("broker_ts"), F.min("l_discount").alias("disc"),
             F.min("l_tax").alias("tax"), F.min("l_quantity").alias("qty"))
        # (part, supplier) is unique within the group, so ordinals never collide; a source has a few messages
        .withColumn("nth", F.row_number().over(
            Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey")))
    )


def _whole_messages(messages: DataFrame) -> DataFrame:
    source_key = F.col("l_orderkey") * SOURCE_KEY_FACTOR + F.col("l_linenumber")
    return messages.withColumns({
        "broker_message_id": source_key * MESSAGE_KEY_FACTOR + F.col("nth"),
        "alert_id": source_key + 1,
        "ingest_ts": F.col("broker_ts") + F.make_dt_interval(secs=F.col("qty").cast("long")),
    })


def _message_probs(messages: DataFrame, truth: DataFrame) -> DataFrame:
    """One message -> its probabilities in the order of the class ids. The terms are written out per class (the list
    is fixed), as compiled expressions: functions over arrays are interpreted."""
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    n = len(dims.FIXTURE_CLASS_IDS)
    weights = [(1 + (7 * pk + 13 * sk + 31 * i + 17 * pk * i) % 50
                + F.when(F.col("gentype") == i * 10, TRUE_CLASS_BONUS).otherwise(0)).alias(f"w{i}") for i in range(1, n + 1)]
    ws = F.array(*[F.col(f"w{i}") for i in range(1, n + 1)])
    cls = (
        messages.join(truth.select(F.col("dia_object_id").alias("l_orderkey"), "gentype"), "l_orderkey")
        .select("broker_message_id", "l_suppkey", "disc", "tax", *weights)
        .select("*", sum((F.col(f"w{i}") for i in range(1, n + 1)), F.lit(0).cast("long")).alias("tot"),
                F.array_position(ws, F.array_max(ws)).alias("best"))
    )

    def probability(i):
        share = (F.col(f"w{i}").cast("double") / F.col("tot").cast("double")) * F.when(F.col("tax") == 0, 0.5).otherwise(1.0)
        return F.when(F.col("disc") == 0, F.when(F.col("best") == i, 1.0).otherwise(0.0)).otherwise(share)

    probs = F.array(*[F.struct(F.lit(c).alias("class_id"), probability(i).alias("probability"))
                      for c, i in sorted((c, i) for i, c in enumerate(dims.FIXTURE_CLASS_IDS, 1))])
    return cls.select("broker_message_id", (F.col("l_suppkey") % 4 + 1).cast("int").alias("classifier_id"),
                      probs.alias("probs"))


# Physical layout hook for the written tables (optional local sort / partition
# columns per table). Classification rows are written as derived, the rows of one
# message contiguous, so a message's rows combine map-side. Two layouts were
# measured at sf0.1 and dropped: a per-classifier directory layout (tasks x
# classifiers small files unless the table is range-clustered first, ~10% slower)
# and object-sorted source/alert tables (~9% slower overall, point lookups only).
LAYOUT: dict[str, dict[str, list[str]]] = {}

#: Table -> folder that holds its columns, where that is not its own.
STORED = {"diasource": "_sources", "diaforcedsource": "_sources", "diaalert": "_sources", "broker_message": "_messages"}

_LOCK = threading.RLock()
_CACHE: dict[tuple[str, str], dict[str, str]] = {}


class _Store:
    """The derived tables of one data set, each written when it is first asked for, once per application."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.written = _CACHE.setdefault((spark.sparkContext.applicationId, sf_dir), {})
        tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
        self.base = join_path(checkpoint_root(spark), "probscope-tables", spark.sparkContext.applicationId, tag)

    def folder(self, name: str) -> str:
        """The folder that holds the columns of a table."""
        return self._write(STORED.get(name, name))

    def paths(self) -> dict[str, str]:
        """A folder of its own for every table."""
        from probscope.sources.io import ARRAY_TABLES, DATA_TABLES
        return {name: self._write(name) for name in DATA_TABLES | ARRAY_TABLES}

    def table(self, name: str) -> DataFrame:
        from probscope.sources.io import ARRAY_TABLES, DATA_TABLES
        schema = (DATA_TABLES | ARRAY_TABLES)[name]
        if name in STORED:
            whole = _whole_sources if STORED[name] == "_sources" else _whole_messages
            return whole(self.spark.read.parquet(self.folder(name))).select(*schema.fieldNames())
        return self.spark.read.schema(schema).parquet(self.folder(name)).select(*schema.fieldNames())

    def _write(self, name: str) -> str:
        with _LOCK:
            if name not in self.written:
                path = join_path(self.base, name)
                layout = LAYOUT.get(name, {})
                df = self._derive(name)
                if layout.get("sort"):
                    df = df.sortWithinPartitions(*layout["sort"])
                writer = df.write.mode("overwrite").option("compression", "zstd")
                if layout.get("partition"):
                    writer = writer.partitionBy(*layout["partition"])
                with shuffles_removed(self.spark):
                    writer.parquet(path)
                self.written[name] = path
            return self.written[name]

    def _derive(self, name: str) -> DataFrame:
        if name == "truth":
            return _truth(self.spark, self.sf_dir)
        if name == "_sources":
            return _sources(self.spark, self.sf_dir, self.table("truth"))
        if name == "_messages":
            return _messages(self.spark, self.sf_dir)
        if name in STORED:
            return self.table(name)
        if name == "broker_classification":
            return self.table("message_probs").select("broker_message_id", "classifier_id", F.inline("probs"))
        return _message_probs(_whole_messages(self.spark.read.parquet(self._write("_messages"))), self.table("truth"))


_TABLES: dict[tuple[str, str, bool], Tables] = {}


def load_tables(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Tables:
    """Domain tables for ``sf_dir``; Parquet-backed unless ``materialize=False``.

    DataFrames are immutable, so one ``Tables`` per application and data set is
    built and handed out as a shallow copy (callers may swap attributes)."""
    key = (spark.sparkContext.applicationId, sf_dir, materialize)
    with _LOCK:
        if key not in _TABLES:
            _TABLES[key] = _build_tables(spark, sf_dir, materialize)
        return _TABLES[key].but()


def _build_tables(spark: SparkSession, sf_dir: str, materialize: bool) -> Tables:
    paths = None
    if materialize:
        from probscope.sources.io import ARRAY_TABLES, DATA_TABLES
        store = _Store(spark, sf_dir)
        paths = Later(store.paths)
        data = {name: Later(lambda name=name: store.table(name)) for name in DATA_TABLES | ARRAY_TABLES}
    else:
        data = derive(spark, sf_dir)
    return Tables(
        **data,
        paths=paths,
        gentype=dims.gentype_of_classid(spark),
        gentype_hier=dims.gentype_of_classid(spark, hierarchical=True),
        classifiers=dims.broker_classifier(spark),
        timebins=dims.maxprob_timebins(spark),
        confusion_classes=dims.confusion_classes(spark),
    )
