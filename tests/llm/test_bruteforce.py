"""Operators against plain versions of their definitions on the smallest tables and on fixtures."""

import hashlib
import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from probscope.llm import (decontamination, ngram_join, pii, queries, secrets, sentencepiece_codec, substring_dedup,
                           token_counts)
from probscope.llm.components import components
from probscope.llm.oracle import oracle_sql
from probscope.llm.queries import tokenizer_path
from tests.verify import _rows, duck


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql(spark, sf_dir, name):
    got = queries.queries()[name](spark, sf_dir)
    rel = duck(sf_dir).sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(rel.columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(list(rel.columns), rel.fetchall())


def plain_units(text):
    word = r"(?:[0-9A-Za-z]|[^\x00-\x7f])+"
    at = 0
    for line in text.split("\n"):
        n = len(re.findall(word, line))
        if n >= substring_dedup.LINE_WORDS:
            yield at, at + len(line), n, tuple(re.findall(word, line.lower()))
        ends = [m.end() for m in re.finditer(r"[.!?](?=[ \t\r]|$)", line)]
        begin = 0
        for end in ends if ends and ends[-1] == len(line) else [*ends, len(line)]:
            found = list(re.finditer(word, line[begin:end]))
            if substring_dedup.SENTENCE_WORDS <= len(found) < n:
                yield (at + begin + found[0].start(), at + end, len(found),
                       tuple(re.findall(word, line[begin:end].lower())))
            begin = end
        at += len(line) + 1


def plain_repeats(texts, least):
    first, rows = {}, []
    for doc in sorted(texts):
        for a, b, n, words in sorted(plain_units(texts[doc]), key=lambda u: u[:2]):
            if words in first:
                rows.append((doc, a, b, n, first[words]))
            else:
                first[words] = doc
    out = []
    for doc, a, b, n, kept in sorted(rows, key=lambda r: (r[0], r[1], -r[2])):
        if not any(d == doc and s <= a and b <= e for d, s, e, *_ in out):
            out.append((doc, a, b, n, kept))
    passages = []
    for row in out:
        if passages and passages[-1][-1][0] == row[0] and row[1] - max(r[2] for r in passages[-1]) < substring_dedup.GAP:
            passages[-1].append(row)
        else:
            passages.append([row])
    return [row for p in passages if sum(r[3] for r in p) >= least for row in p]


@pytest.mark.parametrize("least", [0, substring_dedup.PASSAGE_WORDS])
def test_substring_dedup(spark, documents, texts, least):
    got = [tuple(r) for r in substring_dedup.repeats(documents, least).collect()]
    assert sorted(got) == sorted(plain_repeats(texts, least)) and got


def test_substring_dedup_query(spark, sf_dir, texts):
    """The query returns every repeated unit, short ones too, with the words of its passage."""
    of = defaultdict(list)
    for r in queries.op2_substring_dedup(spark, sf_dir).collect():
        of[r.doc_id].append(r)
    for doc, a, b, n, _ in plain_repeats(texts, 0):
        assert any(r.start <= a and b <= r.end and r.passage_words >= n for r in of[doc]), (doc, a, b)
    assert any(r.passage_words < substring_dedup.PASSAGE_WORDS for rows in of.values() for r in rows)


def test_short_sentences(frame):
    """A repeated passage of short sentences goes, wherever it lies in its line; words of overlapping runs count once."""
    rng = random.Random(3)
    say = lambda n: " ".join("".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(n))
    passage = " ".join(f"{say(n)}." for n in (3, 4, 2, 7, 1, 5, 6, 3, 4, 7))
    docs = frame((1, f"{say(9)}. {passage} {say(9)}."), (2, f"{say(4)}. {passage.upper()} {say(2)}. {say(7)}"))
    rows = substring_dedup.stretches(docs).collect()
    begin = docs.where("doc_id = 2").first().text.index(passage.upper())
    assert {(r.doc_id, r.kept_doc_id, r.passage_words) for r in rows} == {(2, 1, 42)}
    assert min(r.start for r in rows) == begin and max(r.end for r in rows) == begin + len(passage)
    done = substring_dedup.dedupe(docs).where("doc_id = 2").first().text
    assert len(re.findall("[a-zA-Z]+", done)) == 13 and passage.upper()[:20] not in done


def test_short_repeats_go(frame):
    docs = frame((1, "a notice of only six words\nfirst"), (2, "second\na notice of only six words"))
    rows = substring_dedup.dedupe(docs).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["a notice of only six words\nfirst", "second\n"]


def test_one_id_with_several_texts(frame):
    """Spans are of a row's own text; of two rows with one id that share a line, one keeps it."""
    line = "this whole line of words stands in the other text too"
    a, b = f"{line}\nonly here is the first one of them", f"second text has it after that\n{line}\nand goes on alone"
    rows = substring_dedup.dedupe(frame((1, line), (2, a), (2, "let this other text stay whole as it repeats nothing"))).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [
        (1, line), (2, "\nonly here is the first one of them"), (2, "let this other text stay whole as it repeats nothing")]
    rows = [r.text for r in substring_dedup.dedupe(frame((2, a), (2, b))).collect()]
    assert sorted(line in t for t in rows) == [False, True] and all(t in (a, b, a.replace(line, ""), b.replace(line, "")) for t in rows)
    # repeated rows are one document
    rows = substring_dedup.dedupe(frame((2, a), (2, a))).collect()
    assert [r.text for r in rows] == [a, a]


def test_passages_within_lines(frame):
    rng = random.Random(1)
    say = lambda n: " ".join("".join(rng.choices(string.ascii_lowercase, k=5)) for _ in range(n))
    passage = ". ".join(say(12) for _ in range(6)) + "."
    docs = frame((1, f"{say(9)}. {passage} {say(9)}."), (2, f"{say(4)} {passage.upper()} {say(7)}"), (3, say(80)))
    rows = substring_dedup.dedupe(docs).orderBy("doc_id").collect()
    assert [len(r.removed or ()) for r in rows] == [0, 5, 0]  # the first sentence began elsewhere
    assert sum(s.end - s.start for s in rows[1].removed) > 0.8 * len(passage)
    assert rows[2].text == docs.where("doc_id = 3").first().text


def plain_components(texts, k=4, percent=85):
    sets = {}
    for doc, text in texts.items():
        w = text.encode().lower().split()
        sets[doc] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {d: d for d in sets}
    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    inverted = defaultdict(set)
    for doc in sorted(sets):
        met = Counter(y for s in sets[doc] for y in inverted[s])
        for y, both in met.items():
            if 100 * both >= percent * (len(sets[doc]) + len(sets[y]) - both):
                a, b = find(doc), find(y)
                root[max(a, b)] = min(a, b)
        for s in sets[doc]:
            inverted[s].add(doc)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_copies(n, words=60, seed=5):
    """Copies of a text with more and more words changed, at and about the threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = {}
    for i in range(n):
        w = list(base)
        for j in rng.sample(range(words), i % 6):
            w[j] = f"x{rng.randrange(10**9)}"
        out[i] = " ".join(w)
    return out


@pytest.mark.parametrize("block", [1 << 21, 400])
def test_join(frame, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # 400: one cluster is searched in many pairs of blocks
    monkeypatch.setattr(ngram_join, "LONG", 8)
    texts = near_copies(60) | {100 + i: t for i, t in near_copies(20, 9, 6).items()} | {200: "", 201: "a b", 202: "A\tB"}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(frame(*texts.items())).collect()}
    assert got == plain_components(texts)


@pytest.mark.parametrize("percent", [80, 85])
def test_parts_meet(percent):
    """Linked sets share as many parts as either needs, whatever their sizes and hashes."""
    rng = np.random.RandomState(0)
    met = 0
    for n in [*range(5, 40), 55, 90, 200, 777]:
        for _ in range(40):
            x = rng.randint(0, 1 << 62, n).astype(np.uint64) * np.uint64(4)
            y = np.concatenate([x[rng.randint(0, 1 + n // 5):], rng.randint(0, 1 << 62, rng.randint(0, 1 + n // 5)).astype(np.uint64)])
            x, y = np.unique(x), np.unique(y)
            both = len(np.intersect1d(x, y))
            if 100 * both >= percent * (len(x) + len(y) - both) and both < max(len(x), len(y)):
                rows = [defaultdict(dict), defaultdict(dict)]
                for s, out in zip((x, y), rows):
                    for _, scheme, part, need in zip(*ngram_join.contents([s], percent)):
                        out[scheme][part] = need
                ok = [len(rows[0][s].keys() & rows[1][s].keys()) >= max(*rows[0][s].values(), *rows[1][s].values(), 1)
                      for s in rows[0].keys() & rows[1].keys()]
                assert any(ok), (n, len(x), len(y))
                met += 1
    assert met > 300


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: r for x, r in root.items() if x in linked}


def plain_pii(text):
    spans = {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]}
    spans["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
                   if all(int(p) <= 255 for p in m.group().split("."))]
    spans["card"], spans["phone"] = [], []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2]) and (
                sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            spans["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans["phone"].append(m.span())
    return ",".join(f"{k}:{a}:{b}" for k in ("email", "ip", "card", "phone") for a, b in spans[k])


PII = ["a@b.c x.y@z.co.uk, a@@b.c a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 010.020.030.040", "4111 1111-1111 1111 4111111111111112",
       "+1 (988) 555-2485 +12 +1234567890123456 +49.30.123456-", "é+44 20 7946 0958é q@w.e1.2.3.4", "@a.b c@.d e@f. g@h.i."]


def test_pii_base(frame, texts):
    rng = random.Random(3)
    some = [*PII, *texts.values(), *("".join(rng.choices("01 .-+()@a", k=60)) for _ in range(500))]
    docs = frame(*enumerate(some))
    model = pii.train(docs)
    rows = pii.detect(docs, model).select("doc_id", "spans", *[c.alias("all") if i == 5 else c for i, c in enumerate(
        pii.digest_columns(F.col("spans")))]).collect()
    for r in rows:
        plain = plain_pii(some[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(plain.encode()).hexdigest(), some[r.doc_id]
        assert set(filter(None, plain.split(","))) <= set(r.all.split(","))


def test_pii_model(spark):
    model = pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    hits = ["call (415) 555-1234 now", "write to john.doe at example dot com please", "card 4111.1111.1111.1111 ok"]
    for text, kind in zip(hits, ("phone", "email", "card")):
        assert [s[0] for s in pii.find_spans([text], model)[0]] == [kind]
    clean = ["on 2024-05-06 we met", "look at the dot here", "version 3.14.1", "order 12 345 678", "pages 1999-2004"]
    assert pii.find_spans(clean, model) == [[]] * len(clean)
    text = "a@b.cd and +1 (988) 555-2485!"
    assert pii.redacted(text, pii.find_spans([text], pii.Model())[0]) == "<EMAIL> and <PHONE>!"


def test_sentencepiece(frame, texts):
    import sentencepiece
    path = tokenizer_path("piece_bpe_32k.model")
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    some = [*texts.values(), *("".join(rng.choices("ab  \n\t▁é\U0001f600\x00ſ<s>", k=rng.randrange(30))) for _ in range(2000))]
    done = sentencepiece_codec.encode(frame(*enumerate(some)), path, decoded=True, table_size=500)
    for r in done.collect():
        assert r.ids == processor.encode(some[r.doc_id]), some[r.doc_id]
        assert r.decoded == processor.decode(r.ids)
    back = sentencepiece_codec.decode(done.select("doc_id", "ids"), path).collect()
    assert all(r.text == processor.decode(processor.encode(some[r.doc_id])) for r in back)


def plain_secrets(text):
    key = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    rows = [(m.start(), 0, "assign", m.end()) for m in re.finditer(
        rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m.group(2)) >= 8]
    rows += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    rows += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(rows))


def test_secrets(frame, texts):
    rng = random.Random(6)
    letters = string.ascii_letters + string.digits
    odd = ["token=abc password=longvalue1 token=password=longsecret1 token=secret:abcdefghij", "API_KEY : 'abcdefgh", "paſſword=12345678",
           "é token=\"12345678\" AKIAAKIAAKIAAKIA AKIA1", "0" * 31 + " " + "a" * 32 + "éapikey=" + "a" * 40]
    keys = ["".join(rng.choices(letters, k=32)) for _ in range(60)]
    names = [f"my-long-config_name-v{i}-release" for i in range(30)] + [f"src/main/java/com/example/App{i}" for i in range(30)]
    some = [*odd, *texts.values(), *(f"use {k} here" for k in keys), *(f"see {n} there" for n in names)]
    rows = secrets.find(frame(*enumerate(some)))
    rows = rows.select("doc_id", F.col("spans").alias("s"), *secrets.digest_columns(F.col("spans"))).collect()
    for r in rows:
        plain = plain_secrets(some[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(plain.encode()).hexdigest(), some[r.doc_id]
        assert r.n_assign + r.n_access + r.n_hex == len([x for x in plain.split(",") if x])
    added = {some[r.doc_id][s.start:s.end] for r in rows for s in r.s if s.no == 3}
    assert len(added & set(keys)) > 50 and not added & set(names)


def test_token_counts(spark, frame, tmp_path):
    docs = frame((1, "a b c"), (2, "d e"), (3, "f"), (4, None))
    now = token_counts.counted(docs, {})
    path = str(tmp_path / "r")
    token_counts.commit(token_counts.signed(now, 1), path, 1)
    gone, old = now.where("doc_id = 2"), now.where("doc_id = 1")
    new = token_counts.counted(frame((1, "a b c d e f")), {})
    for _ in range(3):  # each batch is delivered three times
        token_counts.commit(token_counts.signed(gone, -1), path, 2)
        token_counts.commit(token_counts.signed(old, -1).union(token_counts.signed(new, 1)), path, 3)
    want = [("src", "en", token_counts.WORDS, 3, 7, 12)]
    assert [tuple(r) for r in token_counts.totals(spark, path).collect()] == want
    token_counts.compact(spark, path, str(tmp_path / "c"), 2)
    assert [tuple(r) for r in token_counts.totals(spark, str(tmp_path / "c")).collect()] == want


def test_token_counts_again(spark, frame, tmp_path):
    """An empty correction replaces the batch; what no log names does not count; no commit is no rollup."""
    path = str(tmp_path / "r")
    assert token_counts.totals(spark, path).count() == 0
    now = token_counts.signed(token_counts.counted(frame((1, "a b c"), (2, "d e")), {}), 1)
    none = token_counts.signed(token_counts.counted(frame(), {}), 1)
    token_counts.commit(none, path, 0)
    token_counts.commit(now, path, 1)
    token_counts.commit(now, path, 2)
    sums = lambda: [(r.n_docs, r.n_tokens, r.n_chars) for r in token_counts.totals(spark, path).collect()]
    assert sums() == [(4, 10, 16)]
    token_counts.commit(none, path, 2)
    assert sums() == [(2, 5, 8)]
    # a writer that is lost before its row of the log is written
    now.groupBy(*token_counts.KEYS).agg(*[F.sum(c).alias(c) for c in token_counts.SUMS]).withColumn(
        "batch_id", F.lit(3).cast("long")).write.parquet(f"{path}/data/folder=commit-lost")
    assert sums() == [(2, 5, 8)]
    token_counts.commit(now, path, 2)
    token_counts.commit(none, path, 1)
    assert sums() == [(2, 5, 8)]


def test_token_counts_query(spark, sf_dir, documents, texts):
    import base64

    import public_tokenizers
    import tiktoken
    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    bpe = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    want = Counter()
    for r in documents.collect():
        mark = labels.get(r.doc_id)
        if mark and mark.quality == 0:
            continue
        text = r.text.partition("\n")[2] if mark and mark.toxic == 1 and "\n" in r.text else r.text
        for name, n in (("words-1", len(text.encode().split())), ("byte-bpe-50k", len(bpe.encode_ordinary(text)))):
            for k, v in (("docs", 1), ("tokens", n), ("chars", len(text))):
                want[r.source, r.lang, name, k] += v
    got = {(r.source, r.lang, r.tokenizer, k): r[f"n_{k}"] for r in queries.op8_token_counts(spark, sf_dir).collect()
           for k in ("docs", "tokens", "chars")}
    assert got == dict(want)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op9_toxicity(spark, sf).collect() if r.doc_id in labels]
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out]
    clean = [p for p, y in held if y == 0]
    assert sum(clean) / len(clean) < 0.02
    assert sum(p == y for p, y in held) / len(held) > 0.97


def edits(window, text):
    """Fewest edits between the window and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(last + (c != d), row[j] + 1, row[j - 1] + 1)
    return row[-1] if not text else min(row)


def plain_fold(text):
    return re.sub(r"(?:[^0-9a-z\x80-\U0010ffff])+", " ", text.lower()).strip()


def test_decontamination(spark, frame):
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choices("abcdef", k=rng.randrange(2, 7))) for _ in range(n))
    items = {i: say(n) for i, n in enumerate((8, 20, 45, 60))} | {10: "tiny", 11: say(4)}
    docs = {}
    for i in range(60):
        item = list(items[i % 4])
        for _ in range(rng.randrange(0, len(item) // 8)):
            j = rng.randrange(len(item))
            item[j:j + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        docs[i] = f"{say(15)} {''.join(item).upper() if i % 2 else ''.join(item)}, {say(10)}"
    docs[60] = say(200)
    want = set()
    for d, text in docs.items():
        for k, item in items.items():
            folded = plain_fold(item)
            n = len(folded)
            if n < decontamination.MIN_ITEM:
                continue
            w = min(n, decontamination.WINDOW)
            most = min(int(decontamination.BUDGET * w), (w - decontamination.Q) // decontamination.Q)
            starts = {*range(0, n - w, decontamination.STRIDE), n - w}
            if any(edits(folded[s:s + w], plain_fold(text)) <= most for s in starts):
                want.add((d, k))
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = decontamination.find(frame(*docs.items()), table).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(want) > 20
    exact = decontamination.find(frame((1, f"É. {items[2].upper()}! {say(5)}")), table).collect()
    assert [(r.item_id, r.start, r.end, r.edits) for r in exact] == [(2, 3, 3 + len(items[2]), 0)]
    # in blocks of items, and in parts of a long text
    assert {(r.doc_id, r.item_id) for r in decontamination.find(frame(*docs.items()), table).collect()} == want


@pytest.mark.parametrize("length", [80, 90, 100])
def test_decontamination_partial(spark, frame, length):
    """Stretches of a long item that are copied whole are found wherever they begin."""
    rng = random.Random(length)
    say = lambda n: " ".join("".join(rng.choices("abcdef", k=rng.randrange(2, 7))) for _ in range(n))
    items = [(i, say(90)[:400].strip()) for i in range(5)]
    docs = []
    for i, (_, item) in enumerate(items):
        for at in range(0, len(item) - length, 7):
            docs.append((len(docs), f"{say(20)} {item[at:at + length]} {say(20)}"))
    found = decontamination.find(frame(*docs), spark.createDataFrame(items, "item_id long, text string"))
    found = {r.doc_id for r in found.collect()}
    assert len(found) / len(docs) > 0.97


def test_decontamination_parts(spark, frame, monkeypatch):
    monkeypatch.setattr(decontamination, "PART", 2000)
    monkeypatch.setattr(decontamination, "BLOCK", 100)
    rng = random.Random(9)
    say = lambda n: " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(n))
    items = [(i, say(30)) for i in range(4)]
    parts = [say(333 + i) for i in range(5)]
    text = parts[0] + "".join(f" {t} {p}" for (_, t), p in zip(items, parts[1:]))
    rows = decontamination.find(frame((1, text)), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.item_id, text[r.start:r.end]) for r in rows) == items


@pytest.mark.parametrize("keys", [1, 3, 10])
def test_secrets_sparse(spark, keys):
    """Of few random candidates in a stratum, hardly more are lost than the floor takes, and names stay refused."""
    rng = random.Random(keys)
    rows = [(f"s{i}", 5, rng.random()) for i in range(300) for _ in range(keys)]
    names = [(f"n{i}", 5, rng.random() * 0.3) for i in range(300) for _ in range(keys + 2)]
    tests = spark.createDataFrame([*rows, *names], "encoding string, band int, p double")
    least = {r.encoding: r.least for r in secrets.thresholds(tests).collect()}
    recall = sum(p >= least.get(e, 2) for e, _, p in rows) / len(rows)
    wrong = sum(p >= least.get(e, 2) for e, _, p in names) / len(names)
    assert recall > 0.8 and wrong < 0.1


def test_secrets_copies(frame):
    """Copies of one key are no evidence against it."""
    key = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
    rows = secrets.find(frame(*((i, f"use {key} here") for i in range(10)))).collect()
    assert all([(s.no, s.start, s.end) for s in r.spans] == [(3, 4, 44)] for r in rows)


def test_secrets_pooled(spark):
    """A key of a rare length goes by the other lengths of its encoding."""
    tests = [("keys", 5, (i + 0.5) / 200) for i in range(200)] + [("keys", 7, 0.07)]
    tests += [("names", 5, 0.3 * (i + 0.5) / 200) for i in range(200)] + [("names", 6, 0.29)]
    rows = secrets.thresholds(spark.createDataFrame(tests, "encoding string, band int, p double")).collect()
    least = {(r.encoding, r.band): r.least for r in rows}
    assert least["keys", 7] <= 0.07 and least.get(("names", 6), 1) > 0.29


def test_secrets_without_digits(frame):
    rng = random.Random(8)
    key = lambda letters, n: "".join(rng.choices(letters, k=n))
    keys = [key(letters, n) for letters in (string.ascii_letters, string.ascii_uppercase) for n in (16, 24, 40) for _ in range(40)]
    keys += [key(string.ascii_letters + "+/", 40) for _ in range(40)]
    names = ["getElementsByClassName", "src/main/java/com/example/App", "MAX_CONNECTIONS_PER_HOST", "ConnectionFactoryBean",
             "internationalization", "HttpServletRequestWrapper", "1234567890123456789"]
    rows = secrets.find(frame(*enumerate([f"use {k} here" for k in [*keys, *names]]))).collect()
    found = {r.doc_id for r in rows if any((s.no, s.start) == (3, 4) for s in r.spans)}
    assert len([i for i in found if i < len(keys)]) > 0.85 * len(keys) and max(found) < len(keys)
