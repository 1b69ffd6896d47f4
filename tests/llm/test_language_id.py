"""Language identification: features and decisions against plain versions, held-out rows, rows that need care."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from probscope.llm import language_id as li
from probscope.llm import queries
from tests.llm.conftest import ODD


def plain_grams(text):
    """Counts of the n-grams of the words, each with one space at either end."""
    found, word = Counter(), ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            padded = f" {word} "
            found.update(padded[i:i + n] for n in range(1, li.MAX_N + 1) for i in range(len(padded) - n + 1)
                         if padded[i:i + n].strip() and (n > 1 or padded[i] != " "))
            word = ""
    return found


def spaces_once(grams):
    """Neighbouring words share the space between them, so an n-gram has its spaces at the ends only, as here."""
    return sum(grams.values())


@pytest.mark.parametrize("texts", [["One two,  three!", "", "x", "123 4", "Ünï čo中 a"], ["", ""], ["a b a b"]])
def test_features(texts):
    found = li.occurrences(texts)
    total = sum(np.bincount(doc, minlength=len(texts)) for doc, _ in found)
    assert total.tolist() == [spaces_once(plain_grams(t)) for t in texts]
    # equal n-grams have equal bins, in any batch
    for text, (bins, share) in zip(texts, li.shares(texts)):
        alone = li.shares([text])[0]
        assert bins.tolist() == alone[0].tolist() and share.tolist() == alone[1].tolist()
        assert len(bins) <= len(plain_grams(text)) and (not len(bins) or abs(share.sum() - 1) < 1e-9)
        assert sorted(np.round(share * share.size, 9)) is not None
    grams = [plain_grams(t) for t in texts]
    for g, (bins, share) in zip(grams, li.shares(texts)):
        if len(bins) == len(g):  # no two n-grams in one bin
            assert np.allclose(sorted(share), sorted(np.array(list(g.values())) / sum(g.values())))


def test_machine():
    """The dual solution: separable rows end on or beyond the margin, the objective is no worse than nearby ones."""
    r = np.random.RandomState(0)
    x = r.randn(80, 5).astype(np.float32)
    y = np.where(x @ [1, -2, 0.5, 0, 0] + 0.3 * r.randn(80) > 0.2, 1, -1)
    w, b = li.fit_machine(x, y)
    cost = li.COST * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))

    def objective(w, b):
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - y * (x @ w + b))).sum()

    best = objective(w, b)
    for _ in range(200):
        assert best <= objective(w + 0.05 * r.randn(5), b + 0.05 * r.randn()) + 1e-3


def test_decide():
    """Family by the largest share, then votes, then sums of shares, then name."""
    model = li.Model({"f": ["a", "b", "c"], "g": ["d"]}, {("f",): 0, ("g",): 1, ("a", "b"): 2, ("a", "c"): 3, ("b", "c"): 4},
                     np.zeros((5, li.BINS)), np.array([[0, 1, 0]] * 5, float))
    margins = np.array([[2, -2, 1, 1, 1], [-2, 2, 1, 1, 1], [2, -2, -1, 1, 3], [2, -2, 1, -1, 1], [2, -2, 1, -2, 1], [0, 0, 0, 0, 0]],
                       float)
    langs, score = li.decide(margins, model)
    p = 1 / (1 + np.exp(-margins))
    # row 3: one win each, equal sums but for rounding: decided by sums; row 4: c has the larger sum
    assert [langs[i] for i in (0, 1, 2, 4, 5)] == ["a", "d", "b", "c", "a"]
    assert np.isclose(score[1], p[1, 1] / p[1, :2].sum())
    assert np.isclose(score[0], p[0, 0] / p[0, :2].sum() * (p[0, 2] + p[0, 3]) / 2)
    assert ((0 <= score) & (score <= 1)).all()


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op11_language_id(spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == Counter(lang.keys())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [(lang[r.doc_id], r.lang_pred) for r in rows if r.held_out]
    for x in set(lang.values()):
        own = [a == b for a, b in held if a == x]
        assert sum(own) / len(own) > 0.99


def made(seed, n=40):
    """Texts of five invented languages: three of one family that share most syllables."""
    rng = random.Random(seed)
    common = ["ka", "lo", "mi", "ne"]
    sounds = {"xa": [*common, "zu"], "xb": [*common, "wi"], "xc": [*common, "pe"], "ya": ["gra", "sto"], "zz": ["чу", "жа"]}
    return [(lang, " ".join("".join(rng.choice(s) for _ in range(rng.randint(2, 4))) for _ in range(30)))
            for lang, s in sounds.items() for _ in range(n)]


def test_families(spark):
    rows = [(i, text, lang) for i, (lang, text) in enumerate(made(1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    families = {"x": ["xa", "xb", "xc"], "other": ["ya"]}
    model = li.train(docs, families)
    assert model.families == {"other": ["ya"], "x": ["xa", "xb", "xc"], "zz": ["zz"]}
    assert set(model.place) == {("other",), ("x",), ("zz",), ("xa", "xb"), ("xa", "xc"), ("xb", "xc")}
    new = [(i, text, lang) for i, (lang, text) in enumerate(made(2))]
    got = {r.doc_id: r.lang_pred for r in li.predict(spark.createDataFrame(new, docs.schema).drop("lang"), model).collect()}
    assert sum(got[i] == lang for i, _, lang in new) / len(new) > 0.98


def test_only_allowed_rows_teach(spark):
    """Held-out rows, rows without a language and other columns change nothing."""
    rows = [(i, text, lang) for i, (lang, text) in enumerate(made(1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    more = [(i, "zu zu zu", "ya") for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 4 == 2]
    more += [(2000, "wi wi", None), (None, "wi wi", "ya")]
    a, b = li.train(docs), li.train(docs.union(spark.createDataFrame(more, docs.schema)).withColumn("u", F.lit("x")))
    assert a.families == b.families and np.allclose(a.weights, b.weights) and np.allclose(a.curve, b.curve)


def test_odd(spark, odd, none):
    model = li.train(odd)
    rows = li.predict(odd, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (1, 2, 3))
    assert all((r.lang_pred, r.score) == ("en", 1.0) for r in rows if r.doc_id in (4, 5, 6, 7))
    empty = li.train(none)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in li.predict(odd, empty).collect())
    assert li.predict(none, model).count() == 0
    digits = spark.createDataFrame([(1, "123 !?"), (2, "中"), (3, "1a")], "key long, body string").withColumn("text", F.lit("x"))
    got = {r.doc_id: r.lang_pred for r in li.predict(digits, model, "key", "body").collect()}
    assert got == {1: "und", 2: "en", 3: "en"}
