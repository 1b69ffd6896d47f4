"""Quality rules with thresholds that adapt to each language and source.

Every document gets a few measures in integers. Per (language, source) each measure
is summed up in a mergeable quantile sketch: counts per bucket, 32 buckets to each
doubling, so that any quantile is off by 1/32 at most, merging is adding, and the
order of the rows does not matter. A small group tells little of itself: its quartiles are blended with those of its
language, and these with those of the corpus, from the merged sketches, with a weight that grows smoothly with
the number of documents and is one half at ``LEAST``. A measure is rejected beyond the upper quartile (or the
lower, for the shortest words) by more than ``FENCE`` times the spread of the
quartiles, which counts as ``SPREAD`` at least. The documents are then joined with
their group's thresholds.

Only DataFrame functions are used. A null or empty text has no words and fails the
base rule; a null language or source is a group like any other; rows with equal or
null ids are judged one by one; further columns are only carried where asked
for. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probscope.llm.common import written

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST = 200
FENCE = 3
#: Least spread of the quartiles of each measure, in its unit; ``short_words`` is rejected below, others above.
SPREAD = {"symbols": 8, "capitals": 40, "repeats": 90, "dup_lines": 200, "stutters": 30,
          "long_words": 60, "short_words": 60}
#: Groups whose thresholds are sent to every task; more are joined.
SENT = 100_000


def once(df: DataFrame, name: str, value: Column, *keep: str | Column) -> DataFrame:
    """``keep`` and ``value``, which is computed once a row however often it is used later on."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def measured(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns ``names`` and the measures of the column ``q_text`` of every row."""
    text = F.col("q_text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = once(docs, "q_lines", lines, *names, "q_text", F.length("q_text").cast("long").alias("n_chars_seen"))
    words = F.array_remove(F.split(text, WHITE), "")
    rows = once(rows, "q_words", words, *names, "n_chars_seen",
                F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
                F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
                F.size("q_lines").cast("long").alias("n_lines"),
                (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"))
    names = [*names, "n_chars_seen", "n_symbols", "n_capitals", "n_lines", "n_dup_lines"]
    rows = once(rows, "q_hash", F.transform("q_words", lambda w: F.xxhash64(w)), *names,
                F.size("q_words").cast("long").alias("n_words"),
                F.length(F.array_join("q_words", "")).cast("long").alias("word_chars"))
    names += ["n_words", "word_chars"]
    span = F.col("q_hash")
    again = F.zip_with(span, F.slice(span, F.lit(2), F.size(span)), lambda a, b: a == b)
    rows = rows.withColumn("n_stutters", F.size(F.filter(again, lambda x: x)).cast("long"))
    names.append("n_stutters")
    for step in (1, 2, 4):  # hashes of 2, 4 and then 8 words
        rows = once(rows, "q_hash", F.zip_with(span, F.slice(span, F.lit(step + 1), F.greatest(
            F.size(span) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b)), *names)
    windows = F.slice("q_hash", F.lit(1), F.greatest(F.size("q_hash") - WINDOW + 1, F.lit(0)))
    rows = once(rows, "q_windows", windows, *names)
    return rows.select(*names, repeated_words(F.col("q_windows")).alias("n_repeat_words"))


def repeated_words(windows: Column) -> Column:
    """Words in windows whose hash is found twice or more, the first included."""
    ordered = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    equal = F.zip_with(ordered, F.slice(ordered, 2, F.size(windows)),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["at"], b["at"])))
    at = F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull()))))
    width = F.zip_with(at, F.slice(at, 2, F.size(windows)),
                       lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        F.aggregate(width, F.lit(0), lambda a, x: a + x)).cast("long")


def shares() -> dict[str, Column]:
    """The measures that the sketches sum up: per mille, and hundredths of characters a word."""
    length = F.expr("100 * word_chars div greatest(n_words, 1)")
    per_mille = lambda a, b: F.expr(f"1000 * {a} div greatest({b}, 1)")
    return {"symbols": per_mille("n_symbols", "n_chars_seen"), "capitals": per_mille("n_capitals", "n_chars_seen"),
            "repeats": per_mille("n_repeat_words", "n_words"), "dup_lines": per_mille("n_dup_lines", "n_lines"),
            "stutters": per_mille("n_stutters", "n_words"),
            "long_words": length, "short_words": length}


def bucket(v: Column) -> Column:
    """Buckets 0 to 63 hold one number each, then 32 buckets each doubling."""
    e = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return e * 32 + F.floor(v / F.pow(F.lit(2.0), e)).cast("long")


def lowest(b: Column) -> Column:
    """The least number of a bucket."""
    e = F.greatest(F.floor(b / 32) - 1, F.lit(0))
    return ((b - e * 32) * F.pow(F.lit(2.0), e)).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): counts of a row per group, measure and bucket."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket"))
                               for k, v in shares().items()]))
    return (rows.select(*group(), each.alias("m")).groupBy("lang", "source", "m.measure", "m.bucket")
            .agg(F.count("*").alias("n")))


def group() -> list[Column]:
    """Language and source, a null one as an empty one."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *by: str) -> DataFrame:
    """The documents and the quartiles of each measure of each group of a sketch."""
    key = ", ".join([*by, "measure"])
    upto = sketch.selectExpr("*", f"sum(n) over (partition by {key} order by bucket) upto",
                             f"sum(n) over (partition by {key}) total")

    def quartile(q: int) -> Column:
        return lowest(F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket"))))

    return upto.groupBy(*by, "measure").agg(F.max("total").alias("total"), quartile(1).alias("q1"),
                                            quartile(3).alias("q3"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """A row per (lang, source): the fence of every measure."""
    own = quartiles(sketch, "lang", "source")
    lang = quartiles(merged(sketch, "lang"), "lang")
    all_ = quartiles(merged(sketch))
    named = lambda df, p: df.select(*[F.col(c).alias(c if c in ("lang", "source", "measure") else p + c)
                                      for c in df.columns])
    rows = own.join(named(lang, "l_"), ["lang", "measure"]).join(named(all_, "a_"), "measure")

    def blend(n: str, own: Column, other: Column) -> Column:
        n = F.col(n).cast("double")
        w = n * n / (n * n + float(LEAST) * float(LEAST))
        return F.floor(w * own + (1 - w) * other)

    pick = lambda c: blend("total", F.col(c), blend("l_total", F.col("l_" + c), F.col("a_" + c)))
    least = F.create_map(*[F.lit(x) for kv in SPREAD.items() for x in kv])
    spread = F.greatest(pick("q3") - pick("q1"), least[F.col("measure")]) * FENCE
    fence = F.when(F.col("measure") == "short_words", pick("q1") - spread).otherwise(pick("q3") + spread)
    return rows.select("lang", "source", "measure", fence.alias("fence")).groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == k, F.col("fence"))).alias(f"max_{k}" if k != "short_words" else "min_words")
          for k in SPREAD])


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(rows: DataFrame, fences: DataFrame) -> DataFrame:
    """``rows`` of measures with base_failed and kept."""
    fences = written(fences, "fences")
    few = fences.count() <= SENT
    keyed = fences.select(F.col("lang").alias("q_lang"), F.col("source").alias("q_source"),
                          *[c for c in fences.columns if c not in ("lang", "source")])
    lang, source = group()
    within = F.lit(True)
    for k, v in shares().items():
        within = within & (v >= F.col("min_words") if k == "short_words" else v <= F.col(f"max_{k}"))
    out = rows.join(F.broadcast(keyed) if few else keyed, (lang == F.col("q_lang")) & (source == F.col("q_source")))
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & within)


def assess(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source") -> DataFrame:
    """(doc_id, lang, source, the measures, base_failed, kept) of every row."""
    asked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"),
                        F.col(source_col).alias("source"), F.coalesce(F.col(text_col), F.lit("")).alias("q_text"))
    rows = written(measured(asked, ["doc_id", "lang", "source"]), "measures")
    return judged(rows, thresholds(sketches(rows)))


def filtered(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (with lang, source) that are kept, with all their columns. The measured
    documents are written once, so that the verdict needs no join by id."""
    columns = docs.columns
    whole = F.struct(*columns).alias("q_row")
    asked = docs.select(whole, "lang", "source", F.coalesce(F.col(text_col), F.lit("")).alias("q_text"))
    rows = written(measured(asked, ["q_row", "lang", "source"]), "measured-docs")
    kept = judged(rows, thresholds(sketches(rows))).where("kept")
    return kept.select(*[F.col("q_row").getField(c).alias(c) for c in columns])
