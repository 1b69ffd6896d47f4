"""Sources and sinks: Parquet summaries, CSV, JSON catalogues, "tight" frames,
parameterised SQL.

Summaries (the precomputed views of the original service) are Parquet tables
partitioned by (classifier_id, true_class_id), so reading one classifier and
true class prunes to one directory.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probscope import schemas as S
from probscope.schemas import CLASS_CATALOG_JSON, CLASSIFIER_CATALOG_JSON, TIGHT_FRAME_JSON
from probscope.session import checkpoint_root, join_path

SUMMARY_PARTITIONS = ("classifier_id", "true_class_id")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A folder under the shared checkpoint root, unique to this application."""
    return join_path(checkpoint_root(spark), "probscope-out", spark.sparkContext.applicationId, *parts)


def write_summary(df: DataFrame, path: str, partition_by: Sequence[str] = SUMMARY_PARTITIONS, large: bool = False,
                  rows_per_file: int = 5_000_000) -> str:
    """Materialise a summary: Parquet partitioned by classifier and true class.

    A small (aggregated) one is only sorted by the partition columns inside each task. A ``large`` one would so
    be written as one file per task and pair: its rows are counted per pair (the pairs are bounded by the
    catalogues) and dealt by pair and a salt sized from the count, so that every file has about
    ``rows_per_file`` rows and a pair with a third of all rows is written by many tasks."""
    keys = list(partition_by)
    if large:
        files = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_files")).alias("_salt")
        df = df.join(files, keys).select(*df.columns, salt).repartition(*keys, "_salt").drop("_salt")
    df.sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(*keys).parquet(path)
    return path


def read_summary(spark: SparkSession, path: str, schema: T.StructType | None = None, **equals) -> DataFrame:
    """Read a summary, optionally filtered by partition values (pruned at listing time)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    for col, value in equals.items():
        df = df.where(F.col(col) == value)
    return df


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows-as-JSON (one object per line) with an explicit schema."""
    return spark.read.schema(schema).json(path)


ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_text(c) -> Column:
    """Wall-clock timestamp as ISO-8601 text with microseconds."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, ISO_FORMAT)


def parse_iso(c) -> Column:
    """ISO-8601 text (``T`` separator, optional fraction and offset) -> UTC wall clock as TIMESTAMP_NTZ. Text without
    an offset is a UTC wall clock already."""
    c = F.col(c) if isinstance(c, str) else c
    instant = F.to_timestamp(F.when(c.rlike(r"[0-9](Z|[+-][0-9]{2}(:?[0-9]{2})?)$"), c))
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.when(instant.isNotNull(), utc).otherwise(F.to_timestamp_ntz(F.when(instant.isNull(), c)))


def parse_class_catalog(df: DataFrame, col: str = "value") -> DataFrame:
    """``{"<classid>": {exactmatch, categorymatch, broadmatch, generalmatch, description,
    gentype: [..]}}`` text -> one row per class."""
    m = F.from_json(F.col(col), CLASS_CATALOG_JSON)
    return (df.select(F.explode(m).alias("k", "v"))
            .select(F.col("k").cast("int").alias("class_id"), "v.description", "v.exactmatch", "v.categorymatch",
                    "v.generalmatch", "v.broadmatch", F.col("v.gentype").alias("gentype")))


def parse_classifier_catalog(df: DataFrame, col: str = "value") -> DataFrame:
    """``{"<id>": {brokername, brokerversion, classifiername, classifierparams}}`` -> rows."""
    m = F.from_json(F.col(col), CLASSIFIER_CATALOG_JSON)
    return (df.select(F.explode(m).alias("k", "v"))
            .select(F.col("k").cast("int").alias("classifier_id"), F.col("v.brokername").alias("broker_name"),
                    F.col("v.brokerversion").alias("broker_version"),
                    F.col("v.classifiername").alias("classifier_name"),
                    F.col("v.classifierparams").alias("classifier_params"), F.col("v.nmessages").alias("n_messages")))


def class_catalog_json(classes: DataFrame) -> DataFrame:
    """Inverse of ``parse_class_catalog`` (one document; the class list is bounded by the
    taxonomy): classes (class_id, description, *match, gentype array) -> ``value`` text."""
    entry = F.struct(F.col("class_id").cast("string").alias("key"),
                     F.struct("exactmatch", "categorymatch", "broadmatch", "generalmatch", "description",
                              "gentype").alias("value"))
    return classes.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))


def _json_cell(c: str, kind: T.DataType | None = None) -> Column:
    """One value as JSON text: quoted text, bare numbers with all their digits, null. Whole and ordinary double numbers and
    plain texts are written by compiled expressions; a generator is set up for each value of the rest."""
    text = F.to_json(F.array(F.col(c)))
    text = F.substring(text, F.lit(2), F.length(text) - 2)
    none = F.when(F.col(c).isNull(), "null")
    if isinstance(kind, T.IntegralType):
        return none.otherwise(F.col(c).cast("string"))
    if isinstance(kind, T.DoubleType):
        return none.when(F.abs(F.col(c)) <= sys.float_info.max, F.col(c).cast("string")).otherwise(text)
    if kind == T.StringType():
        return none.when(F.col(c).rlike("^[A-Za-z0-9 _.:+-]*\\z"), F.concat(F.lit('"'), F.col(c), F.lit('"'))).otherwise(text)
    return text


def to_tight_json(df: DataFrame, by: Sequence[str], index: Sequence[str], columns: Sequence[str],
                  max_rows: int = 1_000_000) -> DataFrame:
    """One pandas ``orient='tight'`` document per ``by`` group. A document is one value, so its size is
    bounded: a group of more than ``max_rows`` rows is an error (choose finer groups)."""
    def row(names: Sequence[str]) -> Column:
        return F.concat(F.lit("["), F.concat_ws(",", *[_json_cell(c, df.schema[c].dataType) for c in names]), F.lit("]"))

    def names(values: Sequence[str]) -> Column:
        return F.to_json(F.array(*[F.lit(v) for v in values]))

    rows = df.groupBy(*by).agg(F.collect_list(F.struct(row(index).alias("i"), row(columns).alias("d"))).alias("r"))
    doc = F.concat(F.lit('{"index":['), F.array_join("r.i", ","), F.lit('],"columns":'), names(columns),
                   F.lit(',"data":['), F.array_join("r.d", ","), F.lit('],"index_names":'), names(index),
                   F.lit(',"column_names":[null]}'))
    too_many = F.raise_error(F.concat(F.lit("too many rows for one document: "), F.size("r").cast("string")))
    return rows.select(*by, F.when(F.size("r") > max_rows, too_many.cast("string")).otherwise(doc).alias("value"))


def parse_tight_json(df: DataFrame, col: str = "value", keep: Sequence[str] = (),
                     index_names: Sequence[str] | None = None, columns: Sequence[str] | None = None,
                     types: Mapping[str, str] | None = None) -> DataFrame:
    """A ``tight`` document -> long rows: index levels and data columns.

    Pass the level / column names when the layout is known; otherwise they are
    read from the first document (one small job). Cells are read as text and cast to ``types`` (name -> type,
    double unless given), so text and 64-bit numbers come through whole; a malformed document or a cell that its
    type cannot hold is an error."""
    # parsed in a step of its own: the checks would parse the document again for each field they read
    parsed = df.select(*keep, F.col(col).alias("_doc"), F.from_json(F.col(col), TIGHT_FRAME_JSON).alias("_t"))
    broken = F.col("_doc").isNotNull() & (F.col("_t.index").isNull() | F.col("_t.data").isNull()
                                          | (F.size("_t.index") != F.size("_t.data")))
    bad = F.raise_error(F.concat(F.lit("not a tight document: "), F.substring("_doc", 1, 80)))
    docs = parsed.select(*keep, F.when(broken, bad.cast(TIGHT_FRAME_JSON)).otherwise(F.col("_t")).alias("t"))
    if index_names is None or columns is None:
        first = docs.select("t.index_names", "t.columns").first()
        index_names, columns = list(first["index_names"]), list(first["columns"])
    kinds = dict(types or {})
    rows = docs.select(*keep, F.explode(F.arrays_zip(F.col("t.index").alias("i"), F.col("t.data").alias("d"))).alias("r"))
    cells = [(F.col("r.i")[k], n) for k, n in enumerate(index_names)] + [(F.col("r.d")[k], n) for k, n in enumerate(columns)]
    return rows.select(*keep, *[c.cast(kinds.get(n, "double")).alias(n) for c, n in cells])


def run_sql(spark: SparkSession, text: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Parameterised SQL: values are bound by the engine (``:name`` markers), never
    formatted into the text; a tuple/list value becomes an array usable with
    ``array_contains(:name, col)``. ``frames`` are referenced as ``{name}``."""
    args: dict[str, Column | object] = {}
    for k, v in (params or {}).items():
        args[k] = F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else v
    return spark.sql(text, args=args, **frames)


DATA_TABLES = {
    "truth": S.DIAOBJECT_TRUTH,
    "diasource": S.DIASOURCE,
    "diaforcedsource": S.DIAFORCEDSOURCE,
    "diaalert": S.DIAALERT,
    "broker_message": S.BROKER_MESSAGE,
    "broker_classification": S.BROKER_CLASSIFICATION,
}
#: The same classifications with one row per message, an optional second layout.
ARRAY_TABLES = {"message_probs": S.MESSAGE_PROBS}
DIM_TABLES = {
    "gentype": S.GENTYPE_OF_CLASSID,
    "gentype_hier": S.GENTYPE_OF_CLASSID,
    "classifiers": S.BROKER_CLASSIFIER,
    "timebins": S.MAXPROB_TIMEBINS,
    "confusion_classes": S.CONFUSION_CLASSES,
}


def read_tables(spark: SparkSession, root: str, catalogues: Mapping[str, DataFrame] | None = None,
                arrays: bool = False):
    """Domain tables from ``<root>/<table>`` Parquet folders with explicit schemas.

    Every catalogue is read from its folder, too, unless the caller passes it in ``catalogues``: a missing folder
    is an error, since another catalogue would silently drop the objects it does not list. Catalogues read from
    files are broadcast only through AQE's measured decision (their size is not known up front). With ``arrays`` the
    folder holds the array form of the classifications, too, from which picks per message need no shuffle."""
    from probscope.sources.fixtures import Tables

    def path(name):
        return join_path(root, name)

    given = dict(catalogues or {})
    if unknown := sorted(set(given) - set(DIM_TABLES)):
        raise ValueError(f"not a catalogue: {', '.join(unknown)}")
    data = {n: spark.read.schema(sch).parquet(path(n)).select(*sch.fieldNames()) for n, sch in DATA_TABLES.items()}
    if arrays:
        data |= {n: spark.read.schema(sch).parquet(path(n)) for n, sch in ARRAY_TABLES.items()}
    cats = {n: given[n] if n in given else spark.read.schema(sch).parquet(path(n)) for n, sch in DIM_TABLES.items()}
    return Tables(**data, **cats, paths={n: path(n) for n in DATA_TABLES})


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "broker_message_id", buckets: int = 512) -> DataFrame:
    """Store a table bucketed (and sorted) by ``key`` at ``path`` and register it in the
    session catalogue; returns the bucketed table.

    Writing the classification and message tables with the same key and bucket
    count lets Spark run the per-message arg-max and the classification-message
    join without shuffling the largest table (the bucket layout already co-locates
    the rows). Choose ``buckets`` so one bucket of the largest table is a few
    hundred MB."""
    spark = df.sparkSession
    # one shuffle at write time so each task writes exactly one bucket file
    # (bucketBy alone writes tasks x buckets files)
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def write_clustered(df: DataFrame, path: str, key: str, rows_per_file: int = 5_000_000, row_group_bytes: int = 16 << 20) -> str:
    """Parquet laid out for lookups by ``key``: files are ranges of the key, sorted, with small row groups, page statistics
    and a Bloom filter of the key in each. A lookup opens the one or two files whose range holds the key and reads a few
    pages of them; a filter on the key is all that a reader needs."""
    files = max(1, -(-df.count() // rows_per_file))
    (df.repartitionByRange(files, key).sortWithinPartitions(key).write
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", str(row_group_bytes))
     .option("parquet.page.row.count.limit", "2000").parquet(path))
    return path
