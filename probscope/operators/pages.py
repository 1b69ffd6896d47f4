"""Deep pages of an ordered listing: count, locate, sort only what holds the page.

``OFFSET m LIMIT n`` merges the first m + n rows in one task. Here the rows are written once in ranges of the order
(``Listing.write``), with the number of rows of each. A page is then located by running sums of these counts, and only the
ranges that hold it are read and sorted; a range has about ``rows`` rows, whatever the listing's length. ``after`` seeks
by the last key instead: only ranges from that key on are read, as many as it takes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Listing:
    """An ordered listing in ranges: folder, schema, order columns (ascending, NULLs last) and (range, rows) in order."""

    spark: SparkSession
    path: str
    schema: str
    order: Sequence[str]
    counts: list[tuple[int, int]]

    @classmethod
    def write(cls, df: DataFrame, order: Sequence[str], path: str, rows: int = 1_000_000) -> Listing:
        """Writes ``df`` in ranges of about ``rows`` rows under ``path``. The order must be total for stable pages; equal
        rows of the leading columns may be in several ranges, since the ranges are those of the whole order."""
        spark = df.sparkSession
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        n = max(1, -(-df.count() // rows))
        ranges = df.repartitionByRange(n, *[F.asc_nulls_last(c) for c in order]).withColumn("_range", F.spark_partition_id())
        ranges.write.partitionBy("_range").parquet(path)
        counts = spark.read.schema(f"{schema}, _range int").parquet(path).groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
        # a row for each range
        return cls(spark, path, schema, order, sorted((r["_range"], r["n"]) for r in counts.collect()))

    def _read(self, ranges: Sequence[int]) -> DataFrame:
        rows = self.spark.read.schema(f"{self.schema}, _range int").parquet(self.path)
        return rows.where(F.col("_range").isin(list(ranges))).drop("_range")

    def _sorted(self, df: DataFrame) -> DataFrame:
        return df.orderBy(*[F.asc_nulls_last(c) for c in self.order])

    def page(self, offset: int, limit: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` of the listing, in order."""
        held, before, upto = [], 0, 0
        for k, n in self.counts:
            if upto < offset + limit and upto + n > offset:
                before = upto if not held else before
                held.append(k)
            upto += n
        return self._sorted(self._read(held)).offset(max(offset - before, 0)).limit(limit if held else 0)

    def after(self, key: Sequence, limit: int) -> DataFrame:
        """The ``limit`` rows that follow ``key`` (values of the order columns, none of them null)."""
        beyond = F.lit(False)
        for i in reversed(range(len(self.order))):
            c = F.col(self.order[i])
            beyond = (c > F.lit(key[i])) | c.isNull() | ((c == F.lit(key[i])) & beyond)
        first = self._read([k for k, _ in self.counts]).where(beyond)
        found, wanted = [], 0
        rows = self.spark.read.schema(f"{self.schema}, _range int").parquet(self.path).where(beyond)
        for k, n in sorted((r["_range"], r["n"]) for r in rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()):
            if wanted >= limit:
                break
            found.append(k)
            wanted += n
        return self._sorted(self._read(found).where(beyond)).limit(limit) if found else first.limit(0)
