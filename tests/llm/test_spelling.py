"""Spelling variants against all pairs of a small vocabulary, and rows that need care."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from probscope.llm import queries, spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def plain(words, ratio=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, around in near.items():
        best = min(around, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def rows(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def vocabulary(seed, letters, n=150, longest=11):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, longest)))
        words.add(w)
        for _ in range(4):
            k, c = rng.randrange(len(w) + 1), rng.choice(letters)
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]])
            if len(w) >= 4:
                words.add(w)
    return {w: rng.choice([2, 3, 20, 25, 250, 3000]) for w in sorted(words)}


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abcdefgh"), (3, "aéß中\U0001f600"), (4, "a")])
def test_near_words(spark, seed, letters, monkeypatch):
    words = vocabulary(seed, letters, 150 if len(letters) > 1 else 6)
    words["a" * 5000], words["a" * 5001] = 2, 30
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    want = plain(words)
    assert any(v[2] for v in want.values()) and rows(spelling.grouped(df)) == want
    # with bigrams that the table of counts does not hold
    monkeypatch.setattr(spelling, "GRAMS", 2)
    assert rows(spelling.grouped(df)) == want


def test_pivots():
    """Two bigrams apart, of the least total count among all choices."""
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(3, 9)
        place = np.array(sorted(rng.sample(range(12), n)))
        count = np.array([rng.randint(1, 50) for _ in range(n)])
        best = min(count[i] + count[j] for i in range(n) for j in range(i) if place[i] - place[j] >= 2)
        word, got = spelling.pivots(np.zeros(n, np.int64), place, count)
        assert len(got) == 2 and abs(got[0] - got[1]) >= 2
        assert sum(count[place == p][0] for p in got) == best


def test_counted(frame):
    texts = [(1, "Kitchens kitchens, kitchens-kitchen2 ÉCOLESS écoless straße"), (2, None), (3, ""), (None, "kitchens kitchens"),
             (1, "Kitchens kitchens"), (4, "short words only"), (5, "naïvement " * 3 + "x" * 100_000 + " " + "x" * 100_000)]
    want = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                want[run] += 1
    got = {r.word: r.n for r in spelling.counted(frame(*texts), spelling.misspelled).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2} and len(got) >= 3


def test_chain(spark):
    """A root is the end of the way over forms."""
    words = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20000, "abcdefghijkl": 200000}
    got = rows(spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain(words) and got["abcdefg"][4] == "abcdefghijkl"


def test_no_rows(spark, frame, odd):
    assert spelling.grouped(spelling.counted(frame(), spelling.misspelled)).count() == 0
    words = spelling.counted(odd)
    assert rows(spelling.grouped(words)) == plain({r.word: r.n for r in words.collect()})


def test_query_columns(spark, sf_dir):
    got = queries.op13_spelling_variants(spark, sf_dir)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
