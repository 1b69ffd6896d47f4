"""Every stage of the pipeline, and all of them, against plain versions; rows that need care."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from probscope.llm import decontamination, pii, quality
from probscope.llm.queries import tokenizer_path
from tests.llm.conftest import DOCS
from tests.llm.test_bruteforce import edits, plain_fold


def shingles(text, k=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\r", " ").replace("\n", " ").replace("\t", " ").split(" ") if w]
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def plain_distinct(rows):
    """The rows that stay: equal rows of one id once, then of each component the one with the smallest id."""
    rows = list(dict.fromkeys(r for r in rows if r[0] is not None)), [r for r in rows if r[0] is None]
    known, loose = rows
    sets = [shingles(t) for _, t, *_ in known]
    root = list(range(len(known)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(known)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(known)):
        groups.setdefault(find(i), []).append(known[i])
    return [sorted(g, key=lambda r: r[0]) for g in groups.values()], loose


def check_distinct(got, rows):
    groups, loose = plain_distinct(rows)
    got = Counter(map(tuple, got))
    assert sum(got.values()) == len(groups) + len(loose)
    for g in groups:
        least = [r for r in g if r[0] == g[0][0]]  # texts of the smallest id
        assert sum(got[r] for r in least) == 1 and sum(got[r] for r in g) == 1
    assert not Counter(loose) - got


def leaks(text, items):
    folded = plain_fold(text)
    for item in map(plain_fold, items):
        n = len(item.encode())
        if n < decontamination.MIN_ITEM:
            continue
        w = min(n, decontamination.WINDOW)
        most = min(int(decontamination.BUDGET * w), (w - decontamination.Q) // decontamination.Q)
        if any(edits(item[s:s + w], folded) <= most for s in {*range(0, n - w, decontamination.STRIDE), n - w}):
            return True
    return False


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghilmnorstu", k=rng.randint(2, 9))) for _ in range(400)]
    return lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def tables(spark, prose, tmp_path_factory):
    """Documents with copies, near copies, leaks, personal data and low quality, some under repeated or null ids."""
    rng = random.Random(13)
    items = [(i, prose(n)) for i, n in enumerate((12, 20, 40))]
    texts = [prose(rng.randint(30, 80)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i]) for i in range(5)]  # copies
    rows += [(200 + i, texts[i].rsplit(" ", 2)[0] + " changed end.") for i in range(5, 10)]  # near copies
    rows += [(300 + i, f"{prose(20)} {items[i % 3][1].upper()} {prose(20)}") for i in range(6)]
    rows += [(400, prose(30) + " write to jane.doe@example.org or +49 30 1234567 now"), (401, prose(25) + " 10.0.0.1")]
    rows += [(500, "too short"), (501, ""), (502, None), (503, "same words again " * 40)]
    rows += [(20, texts[11]), (20, prose(50)), (21, texts[21]), (21, texts[21]), (None, texts[12]), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", f"s{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(rows)], DOCS)
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([*items, (9, None), (10, "x")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, [t for _, t in items]


def rows_of(df):
    return [tuple(r) for r in df.select(*cp.COLUMNS).collect()]


def test_rules(spark, tables):
    path, docs, _ = tables
    got = cp.rules(spark, docs, path)
    assert got.columns == cp.COLUMNS
    verdicts = {(r.doc_id, r.n_words, r.word_chars): r.kept for r in quality.assess(docs).collect()}
    want = [r for r in rows_of(docs) if verdicts[r[0], len((r[1] or "").split()), len("".join((r[1] or "").split()))]]
    assert Counter(rows_of(got)) == Counter(want)
    ids = Counter(r[0] for r in want)
    assert not ids & Counter([500, 501, 502, 503]) and ids[20] == 3 and ids[None] == 1


def test_distinct(spark, tables):
    path, docs, _ = tables
    rows = rows_of(docs)
    got = cp.distinct(spark, docs.withColumn("node", F.lit("x")).withColumn("component_id", F.lit(1)), path)
    assert got.columns == cp.COLUMNS
    # rows that differ in source alone are one row here
    strip = lambda r: r[:2]
    check_distinct(map(strip, rows_of(got)), list(map(strip, rows)))


def test_distinct_by_row(spark, frame):
    """A unique text stays though its id is shared with a copy; equal rows of an id stay once."""
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    got = rows_of(cp.distinct(spark, frame((1, a), (2, a), (2, b), (3, b), (4, "x y"), (4, "x y")), ""))
    assert sorted((r[0], r[1]) for r in got) == [(1, a), (2, b), (4, "x y")]
    got = rows_of(cp.distinct(spark, frame((5, a), (5, a), (3, a)), ""))
    assert [(r[0], r[1]) for r in got] == [(3, a)]


def test_decontaminate(spark, tables):
    path, docs, items = tables
    got = rows_of(cp.decontaminate(spark, docs, path))
    want = [(i, t or "", *rest) for i, t, *rest in rows_of(docs) if not leaks(t or "", items)]
    assert Counter(got) == Counter(want) and len(rows_of(docs)) - len(want) == 6


def test_redact(spark, tables):
    path, docs, _ = tables
    got = rows_of(cp.redact(spark, docs, path))
    model = pii.train(docs)
    spans = pii.detect(docs, model, redact=True, keep=["source"]).collect()
    assert Counter((r[0], r[1]) for r in got) == Counter((r.doc_id, r.redacted) for r in spans)
    by = {r[0]: r[1] for r in got if r[0] in (400, 401)}
    assert "jane" not in by[400] and "1234567" not in by[400] and "10.0.0.1" not in by[401]
    texts = {i: t for i, t, *_ in rows_of(docs)}
    assert all(r[1] == (texts[r[0]] or "") for r in got if r[0] in (0, 1, 2, 501, 502))


def plain_encoding(text):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    ids = library.encode(text or "")
    return ids, library.decode(ids)


def test_encode(spark, tables):
    path, docs, _ = tables
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in cp.encode(spark, docs, path).collect())
    want = Counter((i, tuple(plain_encoding(t)[0]), plain_encoding(t)[1]) for i, t, *_ in rows_of(docs))
    assert got == want


def test_run(spark, tables):
    """All stages: what each of them leaves, from plain versions where there are any, reaches the end."""
    path, docs, items = tables
    got = cp.run(spark, path).collect()
    kept = rows_of(cp.rules(spark, docs, path))
    groups, loose = plain_distinct([r[:2] for r in kept])
    clean = [[t for t in g if not leaks(t[1], items)] for g in groups]
    assert len(got) == sum(1 for g, c in zip(groups, clean) if c) + sum(not leaks(t, items) for _, t in loose)
    ids = Counter(r.doc_id for r in got)
    assert all(ids[i] == 0 for i in (*range(100, 105), *range(200, 210), *range(300, 306), *range(500, 504)))
    assert ids[400] == ids[401] == 1 and ids[20] == 2 and ids[21] == 1
    for r in got:
        if r.doc_id == 400:
            assert "jane" not in r.decoded
        if r.doc_id in (0, 1, 2, 3, 4):
            assert r.ids == plain_encoding(next(t for i, t, *_ in kept if i == r.doc_id))[0]


def test_empty_and_odd(spark, tables, odd, none):
    path, _, _ = tables
    for name, stage in cp.STAGES:
        assert stage(spark, none, path).count() == 0, name
        assert stage(spark, odd, path).count() <= odd.count(), name
    ids = Counter(r.doc_id for r in cp.distinct(spark, odd, path).collect())
    assert ids == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, None: 2})


def test_batches_to_python_are_bounded(spark):
    """Texts reach the workers in batches of bounded bytes, unless the caller has set a size."""
    import pyarrow as pa

    import corpus_pipeline
    from probscope.llm.common import BATCH_BYTES

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes], pa.int64())})

    def largest():
        docs = spark.range(6000).selectExpr("id doc_id", "repeat('word ', 400) text", "'en' lang", "'web' source", "2000L n_chars")
        corpus_pipeline.encode(spark, docs, "")
        return docs.coalesce(1).mapInArrow(run, "n long").agg({"n": "max"}).first()[0]

    try:
        spark.conf.unset(key)
        assert largest() < 1.1 * BATCH_BYTES
        spark.conf.set(key, str(6 << 20))
        assert largest() > 5 << 20 and spark.conf.get(key) == str(6 << 20)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_ids_of_chunks_are_shared():
    """The table of chunks holds one object per id, whatever the number of chunks."""
    import sentencepiece

    from probscope.llm.queries import tokenizer_path
    from probscope.llm.sentencepiece_codec import ChunkTable

    processor = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    table = ChunkTable(processor, 1000)
    texts = ["unusually spelled wordings", " unusually  wordings again ", ""]
    assert table.encode(texts) == processor.encode(texts)
    ids = [i for chunk in table.table.values() for i in chunk]
    assert len({id(i) for i in ids}) == len(set(ids))
