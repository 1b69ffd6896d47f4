"""The registered queries of this subpackage: each applies one operator, with production
parameters, to its whole table and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probscope.llm import (decontamination, hard_negatives, language_id, ngram_join, pii, quality, secrets,
                           sentencepiece_codec, spelling, substring_dedup, token_counts, toxicity, warc)
from probscope.llm.common import read_table, scratch, written


def tokenizer_path(name: str) -> str:
    """Where an installed public tokenizer file lies; the operators take any path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all ``documents``."""
    return quality.assess(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stretches of ``documents`` that repeat a line or sentence of an earlier place, all of them, with the
    repeated words of their passage."""
    return substring_dedup.stretches(read_table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` linked at a Jaccard similarity of 0.85 of their four-word shingles."""
    return ngram_join.join(read_table(spark, sf_dir, "documents"), k=4, percent=85)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    found = pii.detect(docs, pii.train(docs))
    return found.select("doc_id", *pii.digest_columns(F.col("spans")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as archives without repeated payloads, read back."""
    path = scratch(spark, "warc")
    warc.write(warc.resolved(warc.records(read_table(spark, sf_dir, "pages"))), path)
    rows = written(warc.read(spark, path, payloads=False), "warc-records")
    return warc.joined(rows).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded."""
    docs = read_table(spark, sf_dir, "documents")
    done = sentencepiece_codec.encode(docs, tokenizer_path("piece_bpe_32k.model"), decoded=True)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    found = secrets.find(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *secrets.digest_columns(F.col("spans")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of ``documents`` by source, language and tokenizer version after four commits: all documents
    come in, those labelled as of low quality go, other ones labelled toxic lose their first line, and the second
    batch is delivered again."""
    import public_tokenizers
    bpe = {"byte-bpe-50k": (tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)}
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    low = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    low = written(low.where("quality = 0 or toxic = 1"), "token-changes")
    low = F.broadcast(low) if low.count() <= 1 << 20 else low
    now = written(token_counts.counted(docs, bpe), "token-counts")
    gone = now.join(low.where("quality = 0").select("doc_id"), "doc_id", "left_semi")
    toxic = low.where("quality is null or quality != 0").select("doc_id")
    shorter = F.expr("if(instr(text, '\n') > 0, substring(text, instr(text, '\n') + 1), text)")
    revised = token_counts.counted(docs.join(toxic, "doc_id", "left_semi").withColumn("text", shorter), bpe)
    revisions = token_counts.signed(now.join(toxic, "doc_id", "left_semi"), -1).union(token_counts.signed(revised, 1))
    path = scratch(spark, "rollup")
    token_counts.commit(token_counts.signed(now, 1), path, 1)
    token_counts.commit(token_counts.signed(gone, -1), path, 2)
    token_counts.commit(revisions, path, 3)
    token_counts.commit(token_counts.signed(gone, -1), path, 2)
    return token_counts.totals(spark, path)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every text of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of ``documents`` that hold part of an item of ``benchmark``."""
    return decontamination.find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs)).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings``; every seventh one has its label changed."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents``, some misspelled, with their frequent neighbours."""
    words = written(spelling.counted(read_table(spark, sf_dir, "documents"), spelling.misspelled), "words")
    return spelling.grouped(words).select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
