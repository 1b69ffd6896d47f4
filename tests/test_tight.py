"""Documents with text, 64-bit numbers and faults."""

import pytest
from pyspark.errors import PySparkException

from probscope.sources import io

BIG = (1 << 62) + 1


def test_text_and_large_numbers(spark):
    rows = [(1, BIG, "r", 0.1), (1, BIG + 1, 'a"b,]\n', None), (2, 3, None, -1e-300)]
    df = spark.createDataFrame(rows, "g int, id long, band string, x double")
    docs = io.to_tight_json(df, ["g"], ["id"], ["band", "x"])
    back = io.parse_tight_json(docs, keep=["g"], types={"id": "long", "band": "string"})
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_pandas_reads_the_documents(spark):
    import json

    import pandas as pd
    df = spark.createDataFrame([(1, 5, 0.25, "r"), (1, 6, 0.5, "g")], "g int, id long, x double, band string")
    doc = json.loads(io.to_tight_json(df, ["g"], ["id"], ["x", "band"]).first().value)
    frame = pd.DataFrame.from_dict(doc, orient="tight")
    assert sorted(zip((i[0] for i in frame.index), frame["x"], frame["band"])) == [(5, 0.25, "r"), (6, 0.5, "g")]


@pytest.mark.parametrize("text", ["{", '{"columns": ["x"]}', '{"index": [[1]], "columns": ["x"], "data": [], "index_names": ["i"]}',
                                  '{"index": [[1]], "columns": ["x"], "data": [["r"]], "index_names": ["i"]}'])
def test_faults_are_errors(spark, text):
    df = spark.createDataFrame([(text,)], "value string")
    with pytest.raises(PySparkException):
        io.parse_tight_json(df, index_names=["i"], columns=["x"]).collect()


def test_documents_are_bounded(spark):
    df = spark.createDataFrame([(1, i) for i in range(5)], "g int, id long")
    with pytest.raises(PySparkException):
        io.to_tight_json(df, ["g"], ["id"], ["id"], max_rows=4).collect()


def test_cells_are_as_the_generator_writes_them(spark):
    texts = ["r", "", " a_b.c:+-9", 'q"', "\\", "é", "a\n", "\n", "\x01", "a ", None]
    numbers = [0.0, -0.0, 0.1, 1e300, -1e-300, 5e-324, 123456789.125, 1e7, 0.001, float("inf"), float("-inf"), float("nan"), None]
    ids = [0, -1, (1 << 63) - 1, -(1 << 63), None]
    for values, kind in ((texts, "string"), (numbers, "double"), (ids, "long"), ([1, -1, None], "int")):
        df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
        for r in df.select("c", io._json_cell("c", df.schema["c"].dataType).alias("new"), io._json_cell("c").alias("old")).collect():
            assert r.new == r.old, r.c


def test_a_document_is_parsed_once(spark):
    docs = spark.createDataFrame([(1, "{}")], "g int, value string")
    rows = io.parse_tight_json(docs, keep=["g"], index_names=["i"], columns=["x", "y"])
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
