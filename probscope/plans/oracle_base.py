"""DuckDB SQL building blocks for the oracle queries.

The oracle re-derives the domain tables from the pre-registered ``orders`` and
``lineitem`` views with plain SQL, independently of the Spark code, and every
oracle query is ``WITH <these CTEs> <query>``.
"""

from __future__ import annotations

from probscope.sources import dims


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(cols)})"


def _typed(select: str, casts: dict[str, str], cols) -> str:
    exprs = ", ".join(f"CAST({c} AS {casts[c]}) AS {c}" if c in casts else c for c in cols)
    return f"SELECT {exprs} FROM ({select}) AS t"


_GENTYPE_COLS = ["class_id", "gentype", "description"]
_GENTYPE_CASTS = {"class_id": "INTEGER", "gentype": "INTEGER"}
_CFER_COLS = ["classifier_id", "broker_name", "broker_version", "classifier_name", "classifier_params"]


def _timebin_rows():
    lo, hi, width = dims.TIMEBIN_EDGES
    n = int(round((hi - lo) / width))
    rows = [(1, -dims.TIMEBIN_SENTINEL, lo)]
    rows += [(k + 2, lo + width * k, lo + width * (k + 1)) for k in range(n)]
    rows.append((n + 2, hi, dims.TIMEBIN_SENTINEL))
    return rows


CTES = {
    "truth": """
        SELECT o_orderkey AS dia_object_id,
               CASE WHEN o_orderkey % 13 = 5 THEN 60 WHEN o_orderkey % 13 = 7 THEN 70 WHEN o_orderkey % 17 = 3 THEN 80
                    ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 10 END AS gentype,
               CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS peakmjd
        FROM orders""",
    "src_raw": """
        SELECT g.l_orderkey * 10 + g.l_linenumber AS dia_source_id,
               g.l_orderkey AS dia_object_id,
               t.peakmjd
                 + CAST((((date_diff('day', DATE '1970-01-01', CAST(g.ship AS DATE)) - CAST(t.peakmjd AS BIGINT)) % 160)
                          + 160) % 160 AS DOUBLE)
                 - CAST(40.0 AS DOUBLE) AS mid_point_tai,
               g.ps_flux,
               CAST(0.05 AS DOUBLE) * g.ps_flux AS ps_flux_err,
               CASE g.rf WHEN 'R' THEN 'r' WHEN 'A' THEN 'g' WHEN 'N' THEN 'i' END AS filter_name,
               g.ship
        FROM (SELECT l_orderkey, l_linenumber, min(l_shipdate) AS ship, min(l_extendedprice) AS ps_flux,
                     min(l_returnflag) AS rf
              FROM lineitem GROUP BY l_orderkey, l_linenumber) g
        JOIN truth t ON t.dia_object_id = g.l_orderkey""",
    "diasource": """
        SELECT dia_source_id, dia_object_id, mid_point_tai, ps_flux, ps_flux_err, filter_name FROM src_raw""",
    "diaforcedsource": """
        SELECT dia_object_id, mid_point_tai, ps_flux, ps_flux_err, filter_name FROM src_raw""",
    "diaalert": """
        SELECT dia_source_id + 1 AS alert_id, dia_source_id, dia_object_id,
               CASE WHEN dia_object_id % 11 = 0 OR dia_source_id % 7 = 0 THEN NULL ELSE ship END AS alert_sent_ts
        FROM src_raw""",
    "msg_raw": """
        SELECT l_orderkey, l_partkey, l_suppkey,
               (l_orderkey * 10 + l_linenumber) * 1000000
                 + rank() OVER (PARTITION BY l_orderkey * 10 + l_linenumber ORDER BY l_partkey, l_suppkey)
                 AS broker_message_id,
               l_orderkey * 10 + l_linenumber + 1 AS alert_id,
               min(l_shipdate) AS broker_ts, min(l_discount) AS disc, min(l_tax) AS tax,
               min(l_quantity) AS qty
        FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey""",
    "broker_message": """
        SELECT broker_message_id, alert_id, broker_ts, broker_ts + to_seconds(CAST(qty AS BIGINT)) AS ingest_ts
        FROM msg_raw""",
    "cls_w": """
        SELECT m.broker_message_id, m.l_suppkey, m.disc, m.tax, c.idx, c.class_id,
               1 + (7 * m.l_partkey + 13 * m.l_suppkey + 31 * c.idx + 17 * m.l_partkey * c.idx) % 50
                 + CASE WHEN t.gentype = c.idx * 10 THEN 40 ELSE 0 END AS w
        FROM msg_raw m
        JOIN truth t ON t.dia_object_id = m.l_orderkey
        CROSS JOIN (SELECT * FROM (VALUES """ + ", ".join(
        f"({i + 1}, {c})" for i, c in enumerate(dims.FIXTURE_CLASS_IDS)) + """) AS v(idx, class_id)) c""",
    "broker_classification": """
        SELECT broker_message_id,
               CAST(l_suppkey % 4 + 1 AS INTEGER) AS classifier_id,
               CAST(class_id AS INTEGER) AS class_id,
               CASE WHEN disc = 0 THEN
                      CASE WHEN row_number() OVER (PARTITION BY broker_message_id ORDER BY w DESC, idx) = 1
                           THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
                    ELSE CAST(w AS DOUBLE) / CAST(sum(w) OVER (PARTITION BY broker_message_id) AS DOUBLE)
                         * CASE WHEN tax = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END
               END AS probability
        FROM cls_w""",
    "gentype_dim": _typed(_values(dims.EXACT_CLASSES, _GENTYPE_COLS), _GENTYPE_CASTS, _GENTYPE_COLS),
    "gentype_hier": _typed(_values(dims.EXACT_CLASSES + dims.HIER_EXTRA_CLASSES, _GENTYPE_COLS),
                           _GENTYPE_CASTS, _GENTYPE_COLS),
    "classifiers": _typed(_values(dims.CLASSIFIERS, _CFER_COLS), {"classifier_id": "INTEGER"}, _CFER_COLS),
    "timebins": _typed(_values(_timebin_rows(), ["timebin", "dtmin", "dtmax"]),
                       {"timebin": "INTEGER", "dtmin": "DOUBLE", "dtmax": "DOUBLE"}, ["timebin", "dtmin", "dtmax"]),
    "confusion_classes": _typed(
        _values([(2222, 2222), (2222, 2223), (2222, 2224), (2223, 2223), (2223, 2224), (2223, 2232), (2224, 2224),
                 (2224, 2232), (2224, 2242), (2232, 2232), (2232, 2242), (2232, 2312), (2242, 2242), (2242, 2312),
                 (2242, 2322), (2312, 2312), (2312, 2322), (2312, 3121), (2322, 2322), (2322, 3121), (2322, 2222),
                 (3121, 3121), (3121, 2222), (3121, 2223)], ["true_class_id", "class_id"]),
        {"true_class_id": "INTEGER", "class_id": "INTEGER"}, ["true_class_id", "class_id"]),
    # source_classifications view: one row per classification with its source, object and truth
    "msg_ctx": """
        SELECT m.broker_message_id, m.alert_id, m.ingest_ts, a.dia_source_id, a.dia_object_id, a.alert_sent_ts
        FROM broker_message m JOIN diaalert a ON a.alert_id = m.alert_id""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Full oracle query: all fixture CTEs (DuckDB drops unused ones) + ``extra`` + body."""
    parts = dict(CTES)
    if extra:
        parts.update(extra)
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in parts.items())
    return f"WITH {ctes}\n{body}"


def width_bucket_sql(x: str, lo: float, hi: float, n: int) -> str:
    """``width_bucket`` in DuckDB (which has none), with Spark's arithmetic order."""
    lo_s, hi_s = f"CAST({lo!r} AS DOUBLE)", f"CAST({hi!r} AS DOUBLE)"
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) THEN NULL WHEN {x} < {lo_s} THEN CAST(0 AS BIGINT) "
            f"WHEN {x} >= {hi_s} THEN CAST({n + 1} AS BIGINT) "
            f"ELSE CAST(floor(CAST({n} AS DOUBLE) * ({x} - {lo_s}) / ({hi_s} - {lo_s})) AS BIGINT) + 1 END)")


def round6(x: str) -> str:
    """Same operations as the Spark side: floor(x * 1e6 + 0.5000001) / 1e6."""
    return (f"(floor(CAST({x} AS DOUBLE) * CAST(1000000.0 AS DOUBLE) + CAST(0.5000001 AS DOUBLE))"
            " / CAST(1000000.0 AS DOUBLE))")
