"""Language identification in two steps: the family first, then one-versus-one within it.

1. Features: n-grams of 1 to ``MAX_N`` characters of a text's lower-cased words (longest runs of letters,
   with one space at either end), hashed to ``BINS``; a text's feature is the share of its n-grams in a bin.
2. ``train`` draws about ``PER_LANG`` rows of each learned language by a hash of the id (the bound of the
   fit; rarer languages give all their rows). A problem is a family against the others or one language of a
   family against another one; each is a linear support vector machine, fitted by dual coordinate descent in
   a task of its own on at most about 2 * ``PER_LANG`` rows. Each fifth row of the sample is not fitted on:
   a logistic curve over its margins turns margins into shares.
3. ``predict`` takes the family with the largest share, then the language of it that wins most of its
   one-versus-one decisions (ties: larger sum of shares, then name).

``FAMILIES`` names the family of common languages and may be given; a language beyond it is a family of its
own. The score is the family's share (of the shares of all families) times the language's (of its decisions).

Null texts and texts without a letter are ``und`` with score 0; so is every row if nothing can be learned.
With one learned language all other rows are that one with score 1. Rows with null language or id are not
learned from. Repeated and equal ids are predicted row by row; other columns are not read, unless kept. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probscope.llm.common import slices, whole_texts, written
from probscope.llm.shingles import STEP, mix

MAX_N = 4
BINS_LOG2 = 13
BINS = 1 << BINS_LOG2
#: About so many rows of each language are fitted on.
PER_LANG = 2_000
#: Weight of a row's loss in the machines, for features scaled by ``SCALE``; passes over the rows.
COST, SCALE, PASSES = 1.0, 30.0, 60
UNKNOWN = "und"

#: Families of common languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "baltic": ["lt", "lv"],
    "celtic": ["ga", "gd", "cy", "br"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "ky", "uz", "tk", "tt", "ug"],
    "indo-aryan": ["hi", "ur", "bn", "pa", "gu", "mr", "ne", "si"],
    "dravidian": ["ta", "te", "kn", "ml"],
    "iranian": ["fa", "ps", "ku", "tg"],
    "semitic": ["ar", "he", "mt", "am"],
    "austronesian": ["id", "ms", "tl", "jv", "su", "mg"],
}

_letter: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Whether each code point is a letter; made once for each process."""
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letter


def occurrences(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text's number, bin) of every n-gram of the batch, for each n, in order."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "replace"), np.uint32)
    begin = np.cumsum([0] + [len(t) + 1 for t in lowered])
    letter = letter_table()[codes]
    codes = np.where(letter, codes, 0).astype(np.uint64) + np.uint64(1)
    out, h, inside = [], codes, letter
    for n in range(1, MAX_N + 1):
        if n == 2:
            h, inside = h[:-1] * STEP + codes[1:], letter[:-1] | letter[1:]
        elif n > 2:  # a space may stand at the ends only
            h = h[:-1] * STEP + codes[n - 1:]
            inside = (inside[:-1] if n > 3 else True) & letter[n - 2:len(letter) - 1]
        place = np.flatnonzero(inside)
        bins = (mix(h[place] + np.uint64(n)) >> np.uint64(64 - BINS_LOG2)).astype(np.int32)
        cuts = np.searchsorted(place, begin)
        out.append((np.repeat(np.arange(len(texts)), np.diff(cuts)), bins))
    return out


def shares(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bins, share of the text's n-grams) of each text."""
    found = occurrences(texts)
    doc = np.concatenate([d for d, _ in found])
    keys, n = np.unique(doc * BINS + np.concatenate([b for _, b in found]), return_counts=True)
    cuts = np.searchsorted(keys, np.arange(len(texts) + 1) * BINS)
    return [((keys[a:b] % BINS).astype(np.int32), n[a:b] / max(n[a:b].sum(), 1)) for a, b in zip(cuts, cuts[1:])]


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


@dataclass
class Model:
    #: Family name -> its learned languages, both in order of their names.
    families: dict[str, list[str]] = field(default_factory=dict)
    #: Problem -> its place in the arrays; a problem is (family,) or (language, language).
    place: dict[tuple[str, ...], int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, BINS), np.float32))
    #: Per problem: intercept, slope and offset of the logistic curve.
    curve: np.ndarray = field(default_factory=lambda: np.zeros((0, 3)))


def fit_machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine (weights, intercept) by dual coordinate descent; both sides weigh the same."""
    cost = COST * len(y) / (2 * np.where(y > 0, max((y > 0).sum(), 1), max((y < 0).sum(), 1)))
    norm = np.einsum("ij,ij->i", x, x) + 1.0
    w, b, alpha = np.zeros(x.shape[1], x.dtype), 0.0, np.zeros(len(y))
    order = np.random.RandomState(1)
    for _ in range(PASSES):
        worst = 0.0
        for i in order.permutation(len(y)):
            slope = y[i] * (float(w @ x[i]) + b) - 1
            now = min(max(alpha[i] - slope / norm[i], 0.0), cost[i])
            step = now - alpha[i]
            if step:
                w += np.float32(step * y[i]) * x[i]
                b += step * y[i]
                alpha[i] = now
                worst = max(worst, abs(step) * norm[i])
        if worst < 1e-3:
            break
    return w, b


def fit_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the logistic curve through margins, with smoothed targets, by Newton's steps."""
    n = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n[0] + 1) / (n[0] + 2), 1 / (n[1] + 2))
    scale = max(float(np.abs(margin).max(initial=0)), 1e-9)
    x = np.stack([margin / scale, np.ones(len(y))])
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        slope = x @ (p - target) + 1e-3 * theta
        theta = theta - np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2), slope)
        theta = np.clip(theta, [0.0, -30.0], [60.0, 30.0])
    return float(theta[0]) / scale, float(theta[1])


def fitted(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for the problem whose sample rows these are."""
    rows = rows.sort_values(["u", "lang"])
    x = np.zeros((len(rows), BINS), np.float32)
    for i, (b, s) in enumerate(zip(rows["bins"], rows["shares"])):
        x[i, b] = s
    x *= SCALE
    y = rows["side"].to_numpy()
    seen = rows["seen"].to_numpy()
    fit_on = seen if len(set(y[seen])) == 2 else np.ones(len(y), bool)
    w, b = fit_machine(x[fit_on], y[fit_on])
    test = ~seen if len(set(y[~seen])) == 2 else np.ones(len(y), bool)
    slope, offset = fit_curve(x[test] @ w + b, y[test])
    return pd.DataFrame({"problem": rows["problem"].iloc[:1].to_numpy(), "weights": [w * np.float32(SCALE)],
                         "intercept": [b], "slope": [slope], "offset": [offset]})


def sample(docs: DataFrame, lang_col: str, per_lang: int) -> tuple[DataFrame, list[str]]:
    """(lang, u, seen, bins, shares) of about ``per_lang`` rows that may be learned from of each language, u their
    uniform place in the sample; and the languages."""
    rows = (whole_texts(docs.withColumnRenamed(lang_col, "lang") if lang_col != "lang" else docs, keep=["lang"])
            .where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
            .withColumn("lang", F.col("lang").cast("string")))
    # one row for each language
    rates = [(r.lang, min(1.0, per_lang / r.n)) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()]
    if not rates:
        return docs.sparkSession.createDataFrame([], "lang string, u double, seen boolean"), []
    rate = F.broadcast(docs.sparkSession.createDataFrame(rates, "lang string, rate double"))
    u = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("lang")), F.lit(1 << 30)) / (1 << 30)
    chosen = (rows.join(rate, "lang").withColumn("u", u / F.col("rate")).where("u < 1")
              .select("lang", "u", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) != 0).alias("seen"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = shares(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("u"), batch.column("seen"),
                 pa.array([b for b, _ in found], pa.list_(pa.int32())),
                 pa.array([s for _, s in found], pa.list_(pa.float32()))], ["lang", "u", "seen", "bins", "shares"])

    columns = "lang string, u double, seen boolean, bins array<int>, shares array<float>"
    return written(chosen.mapInArrow(run, columns), "lang-sample"), sorted(lang for lang, _ in rates)


def train(docs: DataFrame, families: Mapping[str, list[str]] = FAMILIES, lang_col: str = "lang",
          per_lang: int = PER_LANG) -> Model:
    """The model learned from ``doc_id``, ``text`` and ``lang_col`` of ``docs``, without held-out rows."""
    rows, langs = sample(docs, lang_col, per_lang)
    of = {lang: name for name, members in families.items() for lang in members}
    groups: dict[str, list[str]] = {}
    for lang in langs:
        groups.setdefault(of.get(lang, lang), []).append(lang)
    groups = dict(sorted(groups.items()))
    problems: dict[tuple[str, ...], list[tuple[str, int, float]]] = {}
    if len(groups) > 1:
        for name, own in groups.items():
            problems[(name,)] = [(x, 1 if x in own else -1, 1 / (len(own) if x in own else len(langs) - len(own)))
                                 for x in langs]
    for own in groups.values():
        for i, a in enumerate(own):
            for b in own[i + 1:]:
                problems[a, b] = [(a, 1, 1.0), (b, -1, 1.0)]
    if not problems:
        return Model(groups)
    parts = docs.sparkSession.createDataFrame(
        [(k, *part) for k, p in enumerate(problems.values()) for part in p],
        "problem int, lang string, side int, share double")
    found = (rows.join(F.broadcast(parts), "lang").where("u < share").drop("share").repartition(len(problems), "problem")
             .groupBy("problem").applyInPandas(
                 fitted, "problem int, weights array<float>, intercept double, slope double, offset double"))
    weights, curve = np.zeros((len(problems), BINS), np.float32), np.zeros((len(problems), 3))
    for r in found.collect():  # one row for each problem
        weights[r.problem], curve[r.problem] = r.weights, (r.intercept, r.slope, r.offset)
    return Model(groups, {p: k for k, p in enumerate(problems)}, weights, curve)


def decide(margins: np.ndarray, model: Model) -> tuple[list[str], np.ndarray]:
    """(language, score) of rows from their margins, one column for each problem."""
    p = 1 / (1 + np.exp(-np.clip(margins * model.curve[:, 1] + model.curve[:, 2], -30, 30)))
    n, names = len(margins), list(model.families)
    family = (np.stack([p[:, model.place[(f,)]] for f in names], 1) if len(names) > 1 else np.ones((n, 1)))
    family /= family.sum(1, keepdims=True)
    best = family.argmax(1)
    langs, score = np.empty(n, object), family[np.arange(n), best]
    for k, name in enumerate(names):
        own, at = model.families[name], np.flatnonzero(best == k)
        votes, sums = np.zeros((len(at), len(own))), np.zeros((len(at), len(own)))
        for i in range(len(own)):
            for j in range(i + 1, len(own)):
                q = p[at, model.place[own[i], own[j]]]
                votes[:, i] += q >= 0.5
                votes[:, j] += q < 0.5
                sums[:, i] += q
                sums[:, j] += 1 - q
        won = (votes + sums / (len(own) + 1)).argmax(1)  # the sum of shares is under the number of languages
        langs[at] = np.array(own, object)[won]
        if len(own) > 1:
            score[at] *= sums[np.arange(len(at)), won] / (len(own) - 1)
    return list(langs), score


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BINS floats a problem at any size of the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            found = occurrences(texts)
            total = sum(np.bincount(doc, minlength=len(texts)) for doc, _ in found)
            margins = np.empty((len(texts), len(m.curve)))
            for k, w in enumerate(m.weights):
                margins[:, k] = sum(np.bincount(doc, w[bins], len(texts)) for doc, bins in found)
            margins = margins / np.maximum(total, 1)[:, None] + m.curve[:, 0]
            if m.families:
                langs, score = decide(margins, m)
            else:
                langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            none = total == 0
            langs = [UNKNOWN if x else lang for x, lang in zip(none, langs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(np.where(none, 0.0, score))],
                ["doc_id", "lang_pred", "score"])

    return whole_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")
