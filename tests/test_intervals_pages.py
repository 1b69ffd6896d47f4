"""Interval joins, sliding windows, deep pages, lookups, sketches: against plain versions and by their plans."""

import random
import re
import uuid
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from probscope.operators import diagnostics as dg
from probscope.operators import probhist as ph
from probscope.operators import reshape as rs
from probscope.operators.intervals import interval_join
from probscope.operators.pages import Listing
from probscope.operators.relday import all_rows_with_relday
from probscope.plans import sketches as sk
from probscope.sources import io

INF, NAN = float("inf"), float("nan")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_interval_join(spark):
    rng = random.Random(3)
    spans = [(i, lo, lo + rng.choice([0.0, 0.25, 1.0, 1.0, 3.0, 17.5, 4000.0])) for i in range(300)
             for lo in [rng.choice([rng.uniform(-50, 50), float(rng.randint(-50, 50))])]]
    spans += [(500, -INF, 0.0), (501, 0.0, INF), (502, -INF, INF), (503, None, 1.0), (504, 1.0, NAN), (505, 5.0, 4.0), (506, -1e18, 1e18)]
    points = [(k, rng.choice([rng.uniform(-60, 60), float(rng.randint(-60, 60))])) for k in range(200)]
    points += [(900, None), (901, NAN), (902, -0.0), (903, 1e300)]
    want = sorted((k, i) for k, x in points for i, lo, hi in spans
                  if x is not None and lo is not None and lo <= x < hi and x == x and hi == hi)
    a = spark.createDataFrame(points, "k int, x double")
    b = spark.createDataFrame(spans, "i int, lo double, hi double")
    for base in (0.5, 1.0, 100.0):
        got = interval_join(a, b, "x", "lo", "hi", base)
        assert sorted((r.k, r.i) for r in got.collect()) == want
    assert got.columns == ["k", "x", "i", "lo", "hi"]
    assert interval_join(a, b.limit(0), "x", "lo", "hi").count() == 0 and interval_join(a.limit(0), b, "x", "lo", "hi").count() == 0


def test_many_intervals_without_a_nested_loop(spark):
    """100,000 overlapping intervals of very different lengths."""
    spans = spark.range(100_000).select("id", (F.col("id") % 5000).cast("double").alias("lo"),
                                        ((F.col("id") % 5000) + F.pow(F.lit(2.0), F.col("id") % 9)).alias("hi"))
    points = spark.range(2000).select((F.col("id") * 2.5).alias("x"))
    got = interval_join(points, spans, "x", "lo", "hi")
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    ends = sorted(float(i % 5000) for i in range(100_000))
    stops = sorted(float(i % 5000 + 2 ** (i % 9)) for i in range(100_000))
    xs = [k * 2.5 for k in range(2000)]
    assert got.count() == sum(bisect_left(ends, x + 1e-9) - bisect_left(stops, x + 1e-9) for x in xs)


@pytest.mark.parametrize("rows", [7, 50, 10_000])
def test_pages(spark, rows):
    rng = random.Random(rows)
    data = [(None if rng.random() < 0.05 else rng.choice([1, 1, 1, rng.randint(0, 9)]), i) for i in range(500)]
    rng.shuffle(data)
    path = io.scratch_path(spark, "test-listing", uuid.uuid4().hex[:8])
    listing = Listing.write(spark.createDataFrame(data, "a int, b int").repartition(4), ["a", "b"], path, rows)
    want = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for offset, limit in ((0, 10), (123, 45), (490, 30), (500, 5), (0, 500), (250, 1)):
        assert [tuple(r) for r in listing.page(offset, limit).collect()] == want[offset:offset + limit]
    at = 321
    assert [tuple(r) for r in listing.after(want[at], 20).collect()] == want[at + 1:at + 21]
    assert listing.after((99, 10 ** 6), 5).count() == 5  # NULLs come last
    empty = Listing.write(spark.createDataFrame([], "a int, b int"), ["a", "b"], path + "-none", rows)
    assert empty.page(0, 10).count() == 0 and empty.after((1, 1), 10).count() == 0


def test_deep_page_sorts_few_rows(spark):
    """A page far into the listing reads the ranges that hold it, not what lies before."""
    path = io.scratch_path(spark, "test-listing", uuid.uuid4().hex[:8])
    listing = Listing.write(spark.range(2_000_000).withColumnRenamed("id", "a"), ["a"], path, 100_000)
    page = listing.page(1_500_000, 10)
    assert [r.a for r in page.collect()] == list(range(1_500_000, 1_500_010))
    assert page.inputFiles() and scanned(page) <= 300_000


def scanned(df):
    """Rows that the scans of a plan put out."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_lookup_reads_few_rows(spark):
    n = 1_000_000
    rows = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("k"), F.col("id").alias("v"))
    path = io.write_clustered(rows, io.scratch_path(spark, "test-clustered", uuid.uuid4().hex[:8]), "k", 250_000, 1 << 20)
    found = spark.read.schema("k long, v long").parquet(path).where("k = 12345")
    assert sorted(r.v for r in found.collect()) == sorted(r.v for r in rows.where("k = 12345").collect())
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(k,12345\)", plan(found))
    assert 0 < scanned(found) < n / 100


def test_histogram_family_shuffles_messages(tables, monkeypatch):
    """Classification rows do not cross an exchange where messages are stored as arrays; a source of very many messages is
    averaged in parts, with the same result."""
    df = ph.dedupe_mean(tables)
    # every exchange below the aggregate of means is of message rows or keys
    text = plan(df).split("Union", 1)[-1].split("Subquery")[0]
    first = text[:text.find("BroadcastExchange")] if "BroadcastExchange" in text else text
    assert "Generate inline" in first and first.index("Generate inline") < first.index("Exchange")
    want = sorted(map(tuple, df.collect()))
    monkeypatch.setattr(ph, "MANY_MESSAGES", 1)
    assert sorted(map(tuple, ph.dedupe_mean(tables).collect())) == want


def test_arrays_as_stored_and_as_built(tables):
    built = rs.messages_as_arrays(tables.broker_classification)
    assert sorted(map(repr, built.collect())) == sorted(map(repr, tables.message_probs.select(*built.columns).collect()))


def test_delay_bins(spark):
    values = [-5, 0, 1, 2, 3, 59, 60, 3600, 86400, 10 ** 9, 2 ** 62]
    df = spark.createDataFrame([(v,) for v in values], "s long")
    got = [r.b for r in df.select("s", dg.delay_bin("s").alias("b")).orderBy("s").collect()]
    assert got == sorted(got) and got[0] == -1 and got[-1] < 2016


def test_sketched_quantiles_on_skew_and_ties(spark, tables):
    rng = random.Random(1)
    values = [0.0] * 5000 + [1.0] * 3000 + [rng.random() ** 8 for _ in range(20000)]
    rows = [(i % 40, v) for i, v in enumerate(rng.sample(values, len(values)))]
    df = spark.createDataFrame(rows, "day int, p double").repartition(6)
    days = df.groupBy("day").agg(F.kll_sketch_agg_double("p", sk.K).alias("s"))
    merged = days.agg(F.kll_merge_agg_double("s").alias("s"))
    values.sort()
    for p in (0.01, 0.25, 0.5, 0.75, 0.9, 0.99):
        at = merged.select(F.kll_sketch_get_quantile_double("s", F.lit(p))).first()[0]
        below, upto = sum(v < at for v in values) / len(values), sum(v <= at for v in values) / len(values)
        assert below <= p + sk.RANK_ERROR and upto >= p - sk.RANK_ERROR


def test_sketches_of_any_days(spark, tables):
    root = io.scratch_path(spark, "test-sketches", uuid.uuid4().hex[:8])
    sk.build(tables, root)
    rows = all_rows_with_relday(tables).join(tables.gentype.select("gentype", F.col("class_id").alias("true_class_id")), "gentype")
    for days in ((0, 0), (-40, -5), (10, 60)):
        part = rows.where(F.col("relday").between(*days))
        exact = {(r.classifier_id, r.true_class_id): (r.o, r.s) for r in part.groupBy("classifier_id", "true_class_id").agg(
            F.count_distinct("dia_object_id").alias("o"), F.count_distinct("dia_source_id").alias("s")).collect()}
        got = {(r.classifier_id, r.true_class_id): (r.approx_objects, r.approx_sources)
               for r in sk.distinct(tables, root, days=days).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(a - b) <= sk.DISTINCT_ERROR * b + 0.5 for k in got for a, b in zip(got[k], exact[k]))
        n = sum(r.n for r in sk.quantiles(tables, root, {"q50": 0.5}, days).collect())
        assert n == part.count()
