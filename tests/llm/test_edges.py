"""Nulls, empty and very long texts, repeated rows, clashing columns and empty tables, for every operator."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from probscope.llm import (decontamination, ngram_join, pii, quality, secrets, sentencepiece_codec, substring_dedup,
                           token_counts, toxicity, warc)
from probscope.llm.queries import tokenizer_path
from tests.llm.conftest import ODD

IDS = Counter(i for i, _ in ODD)


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_quality(odd, none):
    rows = quality.assess(odd).collect()
    assert Counter(r.doc_id for r in rows) == IDS
    by = {r.doc_id: r for r in rows}
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[4].n_words == 120_000 and by[5].n_words == 6
    assert quality.assess(none).count() == 0
    kept = quality.filtered(odd)
    assert kept.columns == odd.columns and quality.filtered(none).count() == 0


def test_substring(odd, none):
    rows = substring_dedup.repeats(odd).collect()
    assert {r.doc_id for r in rows} <= {4, None, 6}
    assert ids(substring_dedup.dedupe(odd)) == IDS
    assert substring_dedup.repeats(none).count() == 0 and substring_dedup.dedupe(none).count() == 0


def test_join(odd, none):
    rows = {r.doc_id: r for r in ngram_join.join(odd).collect()}
    assert ids(ngram_join.join(odd)) == IDS
    assert [rows[i].n_shingles for i in (1, 2, 3, 5, 7)] == [0, 0, 0, 3, 1]
    assert all(rows[i].component_id == i for i in (1, 2, 3, 4, 5, 6, 7)) and rows[None].component_id is None
    assert ngram_join.join(none).count() == 0


def test_pii(odd, none):
    model = pii.train(odd)
    rows = pii.detect(odd, model, redact=True, keep=["kept"])
    assert ids(rows) == IDS and rows.columns == ["doc_id", "spans", "redacted", "kept"]
    assert all(not r.spans for r in rows.where("doc_id in (1, 2, 3)").collect())
    assert pii.detect(none, pii.train(none)).count() == 0


def test_sentencepiece(odd, none):
    model = tokenizer_path("piece_bpe_32k.model")
    rows = sentencepiece_codec.encode(odd, model, decoded=True)
    assert ids(rows) == IDS
    assert all(r.ids == [] and r.decoded == "" for r in rows.where("doc_id in (1, 2)").collect())
    assert sentencepiece_codec.decode(sentencepiece_codec.encode(none, model), model).count() == 0


def test_secrets(odd, none):
    rows = secrets.find(odd)
    assert ids(rows) == IDS and all(r.spans == [] for r in rows.collect())
    assert secrets.find(none).count() == 0


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, None), (5, 1, 0), (5, 1, 1), (6, 0, 0), (7, 0, 0), (None, 1, 1), (8, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = toxicity.score(odd, toxicity.train(odd, labels))
    assert ids(rows) == IDS and all(0 <= r.score <= 1 for r in rows.collect())
    assert toxicity.score(none, toxicity.train(none, labels.limit(0))).count() == 0


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "x y"), (None, "same text of two rows here")],
                                  "item_id long, text string")
    rows = decontamination.find(odd, items).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.end) for r in rows) == [(5, None, 0, 26)] * 2
    assert IDS - ids(decontamination.clean(odd, items)) == Counter({5: 2})
    assert decontamination.find(none, items).count() == 0 and decontamination.find(odd, items.limit(0)).count() == 0


def test_token_counts(spark, odd, none, tmp_path):
    rows = token_counts.counted(odd, {})
    assert ids(rows) == IDS
    path = str(tmp_path / "rollup")
    token_counts.commit(token_counts.signed(rows, 1), path, 1)
    token_counts.commit(token_counts.signed(token_counts.counted(none, {}), 1), path, 2)
    got = token_counts.totals(spark, path).collect()
    assert [(r.source, r.lang, r.n_docs) for r in got] == [("src", "en", len(ODD))]


def test_warc(spark, tmp_path):
    tail = "\r\n\r\nWARC/1.1\r\n\r\n" + "x" * 200
    pages = spark.createDataFrame(
        [(1, "http://a", tail, "c"), (3, None, tail, "c"), (2, "http://b\r\nX: y", tail, "c"), (None, "u", tail, "c"),
         (4, "e", None, "c"), (5, "e", "", "c"), (6, "s", "short", "c"), (7, "s", "short", "c"), (1, "http://a", tail, "c"),
         (8, "l", "é\r\n\r\n" * 500_000, "c")], "page_id long, url string, html string, payload string")
    path = str(tmp_path / "a")
    warc.write(warc.resolved(warc.records(pages)), path, "2026-01-01T00:00:00Z")
    rows = warc.joined(warc.read(spark, path)).collect()
    got = sorted((r.page_id if r.page_id is not None else 99, r.record_type, r.refers_to, r.payload_bytes) for r in rows)
    n = len(tail)
    assert got == [(1, "response", None, n), (1, "response", None, n), (2, "revisit", 1, n), (3, "revisit", 1, n),
                   (4, "response", None, 0), (5, "response", None, 0), (6, "response", None, 5), (7, "response", None, 5),
                   (8, "response", None, 3_000_000), (99, "revisit", 1, n)]
    assert all(r.payload == tail for r in rows if r.page_id in (1, 2, 3))
    # an archive that is rewritten keeps its records
    again = str(tmp_path / "b")
    warc.rewrite(spark, path, again)
    second = warc.joined(warc.read(spark, again)).collect()
    assert sorted((r.page_id or 99, r.record_type, r.refers_to, r.payload) for r in second) == sorted(
        (r.page_id or 99, r.record_type, r.refers_to, r.payload) for r in rows)
    empty = str(tmp_path / "none")
    warc.write(warc.resolved(warc.records(pages.limit(0))), empty)
    assert warc.joined(warc.read(spark, empty)).count() == 0


@pytest.mark.parametrize("name", ["text", "doc_id"])
def test_other_column_names(spark, name):
    docs = spark.createDataFrame([(1, "mail a@b.cd now")], "key long, body string").withColumn(name, F.lit("x"))
    found = pii.detect(docs, pii.Model(), id_col="key", text_col="body").collect()
    assert [(r.doc_id, len(r.spans)) for r in found] == [(1, 1)]
