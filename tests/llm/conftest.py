import os

import pytest
from pyspark.sql import DataFrame

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) pairs."""
    def make(*rows: tuple) -> DataFrame:
        return spark.createDataFrame([(i, t, "en", "src", None) for i, t in rows], DOCS)
    return make


LONG = " ".join(f"word{i % 977} of{i % 31}." for i in range(60_000))

#: Rows that every operator has to take: nulls, empty and very long texts, repeated rows, no words.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "same text of two rows here"), (5, "same text of two rows here"),
       (None, "a row without an id"), (None, None), (6, "ÀÉ ñ ß \U0001f600 ▁ x" * 3), (7, "one")]


@pytest.fixture(scope="session")
def odd(frame):
    from pyspark.sql import functions as F
    docs = frame(*ODD)
    # columns whose names clash with those that operators use inside or return
    for name in ("spans", "kept", "n_words", "g", "node", "score", "start", "end", "value", "token", "redacted", "uid",
                 "component_id", "batch_id", "kind", "q_text", "n", "toxic", "ids"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def none(frame):
    return frame()
