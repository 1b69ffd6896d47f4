"""Secrets: base rules and a battery of randomness tests, with DataFrame functions only.

Beside the base rules, runs of 16 or more characters of the usual encodings that hold a letter, and a digit or a
capital, are candidates. The encoding is inferred from the characters: the first of ``ENCODINGS`` that has them all.
Three tests of the hypothesis that the symbols are random are made, the second where the alphabet has several classes:

* chi-squared: the symbols are uniform over the alphabet of the encoding;
* runs: classes of characters (small letters, capitals, digits, signs) follow each other as chance has it,
  against too few changes;
* serial correlation of neighbouring symbols' places in the alphabet.

The least of the three tail probabilities is small for names, paths and numbered words. Its distribution for random
strings is not assumed but made: for each encoding and size that occurs (``sized``, 46 at most), ``MADE`` strings are
drawn from the alphabet by hashes, those that would be candidates of this encoding are tested alike, and p is the share
of them with a lesser value, to one of ``BINS`` bins. So p is uniform for random strings, whatever the length.

Short strings tell less, so the control of false discoveries works per stratum of encoding and length (doublings): by
the number of p over ``HIGH`` the random strings of a stratum are estimated, and the lowest p from which on at most
``RATE`` of the candidates are expected not to be random is its threshold, ``FLOOR`` at least; an estimate of up to ``FEW``
strings is taken a standard error up, larger ones by ever less of it, since a few strings tell little of their number. A stratum of under ``POOL`` candidates
takes what it lacks from the other lengths of its encoding, half as much for each doubling between. Each edge of a bin is
tried, so that the control needs no global order; a string that occurs often counts once, as its copies are no further
evidence. Equal p share a bin and so a verdict. Candidates that touch a base span, and plain numbers, add nothing.

A null text is an empty one; empty texts have no spans; rows with equal or null ids are searched one
by one; further columns are not read; an empty table gives an empty result. Texts are searched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probscope.llm.common import whole_texts, written

_any = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
_names = "|".join(map(_any, ("password", "passwd", "secret", "token"))) + "|" + _any("api") + "_?" + _any("key")
_signs = "A-Za-z0-9+/_=-"

#: kind -> pattern. The base kinds' order is that of their listing.
PATTERNS = {
    "assign": rf"""({_names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{32,}",
    "random": rf"(?<![{_signs}])(?=[a-z+/_=-]*+[A-Z0-9])(?=[0-9+/_=-]*+[A-Za-z])[{_signs}]{{16,}}",
}
KINDS = list(PATTERNS)
#: encoding -> characters, in the order in which they are tried
_digits, _small, _big = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {"hex": _digits + "abcdef", "upper hex": _digits + "ABCDEF", "capitals": _big,
             "base32": _big + "234567", "lower": _digits + _small, "upper": _digits + _big,
             "letters": _big + _small, "alphanumeric": _big + _small + _digits,
             "signed letters": _big + _small + "+/", "url letters": _big + _small + "_-",
             "base64": _big + _small + _digits + "+/", "base64url": _big + _small + _digits + "_-",
             "signed": _big + _small + _digits + "+/_-"}
RATE = 0.05
FLOOR = 0.05
#: Names hardly reach this p, so that the candidates above it tell how many are random.
HIGH = 0.35
BINS = 40
#: Random strings of an encoding and size that are made to learn how its least tail probability is distributed.
MADE = 4000
EDGES = 100
#: Estimates up to so many are taken a standard error up.
FEW = 300
#: Strata of fewer candidates are filled up to so many from the other lengths of their encoding
POOL = 20


def hits(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(uid, doc_id, found): a row per row; found has for each kind the matches, each with the characters before it."""
    rows = whole_texts(docs, id_col, text_col)

    def found(pattern: str) -> Column:
        matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        gaps = F.zip_with(F.split("text", pattern, -1), matches, lambda gap, m: F.struct(
            F.length(gap).alias("gap"), F.length(m).alias("n"), m.alias("value")))
        return F.when(F.col("text").rlike(pattern), F.filter(gaps, lambda g: g["value"].isNotNull()))

    return rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id",
                       *[found(p).alias(k) for k, p in PATTERNS.items()])


def placed(rows: DataFrame) -> DataFrame:
    """(uid, kind, start, end, value) of every match that keeps its rule's length."""
    parts = [rows.where(F.col(k).isNotNull()).select("uid", F.lit(i).alias("kind"), F.posexplode(k))
             for i, k in enumerate(KINDS)]
    each = parts[0]
    for p in parts[1:]:
        each = each.union(p)
    each = each.select("uid", "kind", "col.value", "col.n", F.expr(
        "sum(col.gap + col.n) over (partition by uid, kind order by pos)").cast("int").alias("end"))
    value = F.regexp_extract("value", PATTERNS["assign"], 2)
    keeps = F.when(F.col("kind") == 0, F.length(value) >= 8).when(F.col("kind") == 1, F.col("n") >= 16).otherwise(True)
    return each.where(keeps).select("uid", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "value")


def normal(z: Column) -> Column:
    """The normal distribution function, to 2e-4."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(-(0.07056 * z * z * z + 1.5976 * z)))


def inferred(text: Column) -> Column:
    """The first encoding that has all characters; the last one for any other text."""
    *names, found = ENCODINGS
    found = F.lit(found)
    for name in reversed(names):  # "-" stands last in an alphabet, where a class takes it as itself
        found = F.when(text.rlike(f"^[{ENCODINGS[name]}]+$"), name).otherwise(found)
    return found


def sized(n: Column) -> Column:
    """The length whose distribution stands for this one: itself up to 32, then in steps of 4, of 16 from 48, up to 96."""
    step = F.when(n <= 32, 1).when(n <= 48, 4).otherwise(16)
    return F.least(n - n % step, F.lit(96)).cast("int")


def alphabets(spark: SparkSession) -> DataFrame:
    """(encoding, alphabet, k, same, thrice): its characters, how many, and the sums of the second and third powers of the
    shares of small letters, capitals, digits and signs."""
    rows = []
    for name, letters in ENCODINGS.items():
        shares = [sum(c in group for c in letters) / len(letters) for group in (_small, _big, _digits, "+/_-")]
        rows.append((name, letters, float(len(letters)), sum(x ** 2 for x in shares), sum(x ** 3 for x in shares)))
    return F.broadcast(spark.createDataFrame(rows, "encoding string, alphabet string, k double, same double, thrice double"))


def least_tail(rows: DataFrame) -> DataFrame:
    """``rows``, which have ``text`` and ``encoding``, with the least tail probability ``t`` of the three tests."""
    kept = rows.columns
    rows = rows.join(alphabets(rows.sparkSession), "encoding")
    # characters outside the alphabet stand at no place and are left to the runs
    codes = F.filter(F.transform(F.split("text", ""), lambda c: F.when(c != "", F.instr(F.col("alphabet"), c))),
                     lambda c: c > 0)
    counts = F.transform(F.split("alphabet", ""), lambda c: F.when(
        c != "", F.length("text") - F.length(F.replace(F.col("text"), c, F.lit("")))).otherwise(0))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        "text", "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "[^aA0]", "-")
    rows = rows.select("*", F.explode(F.array(codes)).alias("codes"), classes.alias("classes")).select(
        "*", F.size("codes").cast("double").alias("n"),
        F.aggregate(counts, F.lit(0.0), lambda a, c: a + c.cast("double") * c).alias("squares"),
        F.length(F.regexp_replace("classes", r"(.)\1+", "$1")).cast("double").alias("runs"),
        F.aggregate("codes", F.lit(0.0), lambda a, c: a + c).alias("total")).where("n >= 8")
    rows = rows.withColumn("mean", F.col("total") / F.col("n"))

    rows = rows.withColumns({
        "within": F.aggregate(F.transform("codes", lambda c: (c - F.col("mean")) * (c - F.col("mean"))), F.lit(0.0),
                              lambda a, x: a + x),
        "between": F.aggregate(F.zip_with("codes", F.slice("codes", 2, F.length("text")), lambda a, b: F.coalesce(
            (a - F.col("mean")) * (b - F.col("mean")), F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)})
    df = F.col("k") - 1
    chi = F.col("k") / F.col("n") * F.col("squares") - F.col("n")
    chi_z = (F.cbrt(chi / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    # neighbouring changes share a symbol, hence the second term of their variance
    change, same = 1 - F.col("same"), F.col("same")
    spread = (F.col("n") - 1) * change * same + 2 * (F.col("n") - 2) * (F.col("thrice") - same * same)
    # an alphabet of one class has no runs to test: null, which least() passes over
    runs_z = F.when(change > 0, (F.col("runs") - 0.5 - (F.col("n") - 1) * change) / F.sqrt(spread))
    serial_z = F.when(F.col("within") > 0, F.abs(F.col("between") / F.col("within") + 1 / F.col("n"))
                      * F.sqrt("n")).otherwise(8.0)
    least = F.least(1 - normal(chi_z), normal(runs_z), 2 * (1 - normal(serial_z)))
    return rows.select(*kept, least.alias("t"))


def random_tails(strata: DataFrame) -> DataFrame:
    """(encoding, size, cuts): the edges of ``EDGES`` equal shares of t among random strings of each (encoding, size)."""
    place = lambda i: 1 + F.pmod(F.xxhash64("size", "sample", i, "encoding"), F.col("k").cast("long"))
    samples = (strata.join(alphabets(strata.sparkSession), "encoding")
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(MADE // 100 - 1))))
               .repartition("encoding", "size", "part")
               .withColumn("sample", F.explode(F.sequence(F.col("part") * 100, F.col("part") * 100 + 99)))
               .withColumn("text", F.array_join(F.transform(F.sequence(F.lit(1), F.col("size")), lambda i: F.substr(
                   F.col("alphabet"), place(i).cast("int"), F.lit(1))), "")))
    samples = samples.where(F.col("text").rlike("[A-Z0-9]") & F.col("text").rlike("[A-Za-z]")
                            & (inferred(F.col("text")) == F.col("encoding")))
    edges = F.array(*[F.lit(i / EDGES) for i in range(1, EDGES)])
    return least_tail(samples.select("encoding", "size", "text")).groupBy("encoding", "size").agg(
        F.percentile("t", edges).alias("cuts"))


def tested(candidates: DataFrame) -> DataFrame:
    """(uid, start, end, encoding, string, band, p) of ``candidates``: hash of the string, doublings of length."""
    rows = candidates.withColumn("text", F.regexp_replace("value", "=+$", ""))
    rows = rows.withColumn("encoding", inferred(F.col("text"))).withColumn("size", sized(F.length("text")))
    rows = least_tail(rows.select("uid", "start", "end", "text", "encoding", "size")).select(
        "uid", "start", "end", "encoding", "size", F.xxhash64("text").alias("string"),
        F.floor(F.log2(F.length("text"))).cast("int").alias("band"), "t")
    rows = written(rows, "secret-tails")
    # a row for each encoding and size: 13 times 31 at most
    cuts = F.broadcast(written(random_tails(rows.select("encoding", "size").distinct()), "random-tails"))
    under = F.size(F.filter("cuts", lambda c: c < F.col("t")))
    upto = F.size(F.filter("cuts", lambda c: c <= F.col("t")))
    spread = F.pmod(F.xxhash64("string", F.lit("spread")), F.lit(1 << 30)) / (1 << 30)
    p = (under + spread * (upto - under + 1)) / EDGES
    return rows.join(cuts, ["encoding", "size"], "left").select(
        "uid", "start", "end", "encoding", "string", "band", F.when(F.col("cuts").isNotNull(), p).otherwise(0.0).alias("p"))


def thresholds(tests: DataFrame) -> DataFrame:
    """(encoding, band, least): the p from which on a candidate of the stratum counts as random."""
    counts = tests.groupBy("encoding", "band", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin")).agg(
        F.count("*").cast("double").alias("c"))
    # a row for each stratum, with the counts of all bins: 13 times 31 at most
    strata = counts.groupBy("encoding", "band").agg(
        F.array(*[F.sum(F.when(F.col("bin") == i, F.col("c")).otherwise(0.0)) for i in range(BINS)]).alias("own"),
        F.sum("c").alias("m"))
    near = strata.select("encoding", F.col("band").alias("other"), F.col("own").alias("c"), F.col("m").alias("n"))
    weight = F.when(F.col("other") != F.col("band"), F.pow(F.lit(0.5), F.abs(F.col("other") - F.col("band")))).otherwise(0.0)
    pooled = strata.join(near, "encoding").withColumn("weight", weight).groupBy("encoding", "band").agg(
        F.first("own").alias("own"), F.first("m").alias("m"), F.sum(F.col("weight") * F.col("n")).alias("n"),
        F.array(*[F.sum(F.col("weight") * F.col("c")[i]) for i in range(BINS)]).alias("others"))
    lacks = F.greatest(F.lit(POOL) - F.col("m"), F.lit(0.0))
    share = F.coalesce(F.least(F.try_divide(lacks, F.col("n")), F.lit(1.0)), F.lit(0.0))
    pooled = pooled.withColumn("share", share).withColumn("c", F.zip_with(
        "own", "others", lambda own, other: own + F.col("share") * other))

    def over(i: Column) -> Column:
        return F.aggregate(F.slice("c", i + 1, BINS), F.lit(0.0), lambda a, x: a + x)

    # every edge is tried, whether or not a candidate lies in the bin above it
    cuts = pooled.select("encoding", "band", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("bin"), "c").select(
        "encoding", "band", F.greatest(F.col("bin") / BINS, F.lit(FLOOR)).alias("low"), over(F.col("bin")).alias("accepted"),
        (over(F.lit(int(BINS * HIGH))) / (1 - HIGH)).alias("estimate"), over(F.lit(0)).alias("m"))
    slack = (F.sqrt("estimate") + 1) * F.least(F.lit(1.0), FEW / F.greatest("estimate", F.lit(1.0)))
    random = F.least(F.col("estimate") + slack, F.col("m"))
    wrong = F.col("accepted") - random * (1 - F.col("low"))
    return cuts.where(wrong <= (RATE + 1e-9) * F.col("accepted")).groupBy("encoding", "band").agg(
        F.min("low").alias("least"))


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row: spans (start, no, kind, end) by start and kind, ``no`` under 3 for base spans."""
    rows = written(hits(docs, id_col, text_col), "secret-hits")
    spans = written(placed(rows), "secret-spans")
    base = spans.where("kind < 3").select("uid", "start", "end", "kind")
    touched = spans.where("kind = 3").join(
        base.select("uid", F.col("start").alias("s"), F.col("end").alias("e")), "uid", "left").groupBy(
        "uid", "start", "end", "value").agg(F.max((F.col("start") < F.col("e")) & (F.col("s") < F.col("end"))).alias("t"))
    tests = written(tested(touched.where("t is null or not t").drop("t")), "secret-tests")
    # a row for each encoding and doubling of length: 13 times 31 at most
    least = thresholds(tests.dropDuplicates(["encoding", "band", "string"]))
    added = tests.join(F.broadcast(least), ["encoding", "band"]).where("p >= least").select(
        "uid", "start", "end", F.lit(3).alias("kind"))
    names = F.array(*map(F.lit, KINDS))
    all_ = base.union(added).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct(
        "start", F.col("kind").alias("no"), names[F.col("kind")].alias("kind"), "end"))).alias("spans"))
    none = F.expr("cast(array() as array<struct<start:int,no:int,kind:string,end:int>>)")
    return rows.select("uid", "doc_id").join(all_, "uid", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans"))


def digest_columns(spans: Column) -> list[Column]:
    """Counts of the base spans by kind, their digest, and all spans as text."""
    base = F.filter(spans, lambda s: s["no"] < 3)

    def text(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                      s["end"].cast("string"))), ",")

    def of(i: int) -> Column:
        return F.size(F.filter(base, lambda s: s["no"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    return [*map(of, range(3)), F.sha2(text(base), 256).alias("base_sha256"), text(spans).alias("spans")]
