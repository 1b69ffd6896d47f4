"""probscope: judge probabilistic classifiers of time-stamped detections at scale.

Every operator is ``DataFrame -> DataFrame`` built from Spark SQL / DataFrame
built-ins (no Python UDFs). Sub-packages:

* ``sources``   - domain tables, literal dimensions, Parquet/CSV/JSON I/O
* ``functions`` - column expressions (bins, centres, labels, exact sums)
* ``operators`` - the analytics (pick-one, confusion, histograms, ...)
* ``plans``     - registered queries, their DuckDB oracles, the summary job
* ``streaming`` - Structured Streaming form of the alert-rate metric

Entry points: ``probscope.api.Metrics`` over a ``Tables`` from
``probscope.sources.io.read_tables`` (your Parquet folders) or
``probscope.sources.fixtures.load_tables`` (the test data).
"""

__version__ = "0.1.0"
__all__ = ["sources", "functions", "operators", "plans", "streaming", "api"]
