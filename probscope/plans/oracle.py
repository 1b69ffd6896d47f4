"""DuckDB oracle SQL, one statement per registered query (written independently
of the Spark code, in the reference's own SQL style: DISTINCT-ON-like
``row_number``, per-classifier LEFT joins, plain GROUP BY)."""

from __future__ import annotations

from probscope.plans.oracle_base import round6, width_bucket_sql, with_ctes

_ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, extra: dict[str, str] | None = None) -> None:
    _ORACLE[name] = with_ctes(body, extra)


def oracle_sql() -> dict[str, str]:
    from probscope.plans import oracle_added, oracle_more  # noqa: F401  (register the remaining families)
    return dict(_ORACLE)


CNAME = ("coalesce(cf.broker_name, 'None') || ' ' || coalesce(cf.broker_version, 'None') || ' ' || "
         "coalesce(cf.classifier_name, 'None')")

ORDERS = {
    "last_best": "a.alert_sent_ts DESC NULLS FIRST, c.probability DESC NULLS FIRST",
    "best": "c.probability DESC NULLS FIRST, a.alert_sent_ts DESC NULLS FIRST",
    "nth": "c.probability DESC NULLS FIRST",
}


def chosen_sql(definition: str, nth: int = 3) -> str:
    nth_join = ""
    if definition == "nth":
        nth_join = f"""JOIN (SELECT dia_source_id FROM (
                 SELECT dia_source_id, row_number() OVER (PARTITION BY dia_object_id
                        ORDER BY mid_point_tai, dia_source_id) AS nd FROM diasource) q WHERE nd = {int(nth)}) nd
               ON nd.dia_source_id = a.dia_source_id"""
    return f"""
        SELECT classifier_id, dia_object_id, class_id, probability, alert_sent_ts FROM (
          SELECT c.classifier_id, a.dia_object_id, c.class_id, c.probability, a.alert_sent_ts,
                 row_number() OVER (PARTITION BY c.classifier_id, a.dia_object_id
                                    ORDER BY {ORDERS[definition]}, c.class_id ASC, c.broker_message_id ASC) AS rn
          FROM broker_classification c
          JOIN broker_message m ON m.broker_message_id = c.broker_message_id
          JOIN diaalert a ON a.alert_id = m.alert_id
          {nth_join}) x
        WHERE rn = 1"""


def _inner(definition: str, gentype: str = "gentype_dim") -> str:
    return f"""
        SELECT b.class_id AS pred_class, g.class_id AS true_class, count(*) AS n, b.classifier_id,
               {CNAME} AS classifier_name
        FROM truth t
        JOIN {gentype} g ON t.gentype = g.gentype
        JOIN best b ON b.dia_object_id = t.dia_object_id
        JOIN classifiers cf ON cf.classifier_id = b.classifier_id
        GROUP BY ALL"""


oracle("confusion_last_best", _inner("last_best"), {"best": chosen_sql("last_best")})
oracle("confusion_best", _inner("best"), {"best": chosen_sql("best")})
oracle("confusion_nth", _inner("nth"), {"best": chosen_sql("nth")})
oracle("confusion_hier_best", _inner("best", "gentype_hier"), {"best": chosen_sql("best")})

# Reference semantics of include_missed: per classifier, sent objects LEFT JOIN the chosen one.
MISSED_COUNTS = f"""
        SELECT COALESCE(b.class_id, -1) AS pred_class, g.class_id AS true_class, count(*) AS n,
               cf.classifier_id, {CNAME} AS classifier_name
        FROM classifiers cf
        CROSS JOIN truth t
        JOIN gentype_dim g ON t.gentype = g.gentype
        JOIN (SELECT dia_object_id, bool_or(alert_sent_ts IS NOT NULL) AS is_sent
              FROM diaalert GROUP BY dia_object_id) s ON s.dia_object_id = t.dia_object_id
        LEFT JOIN best b ON b.dia_object_id = t.dia_object_id AND b.classifier_id = cf.classifier_id
        WHERE s.is_sent
        GROUP BY ALL"""
_MISSED_CTE = {"best": chosen_sql("last_best"), "counts": MISSED_COUNTS}
oracle("confusion_with_missed", "SELECT * FROM counts", _MISSED_CTE)

_NORM_PART = {"true": "classifier_id, true_class", "pred": "classifier_id, pred_class", "all": "classifier_id"}
for _norm, _part in _NORM_PART.items():
    oracle(f"confusion_norm_{_norm}", f"""
        SELECT classifier_id, pred_class, true_class, n,
               {round6(f'coalesce(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY {_part}), 0.0)')} AS fraction
        FROM counts""", _MISSED_CTE)

_DENSE = """
        SELECT tc.classifier_id, tc.true_class, pc.pred_class, CAST(coalesce(c.n, 0) AS BIGINT) AS n
        FROM (SELECT DISTINCT classifier_id, true_class FROM counts) tc
        JOIN (SELECT DISTINCT classifier_id, pred_class FROM counts) pc ON pc.classifier_id = tc.classifier_id
        LEFT JOIN counts c ON c.classifier_id = tc.classifier_id AND c.true_class = tc.true_class
                          AND c.pred_class = pc.pred_class"""
_DENSE_FRAC = f"""
        SELECT *, coalesce(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY classifier_id, true_class), 0.0) AS fraction
        FROM ({_DENSE}) d"""
oracle("confusion_dense", f"""
        SELECT classifier_id, true_class, pred_class, n, {round6('fraction')} AS fraction FROM dense""",
       {**_MISSED_CTE, "dense": _DENSE_FRAC})

_NAMES = """
        SELECT class_id, min(description) AS description FROM gentype_hier GROUP BY class_id
        UNION ALL SELECT -1, 'missed'"""
oracle("confusion_annotated", f"""
        SELECT d.classifier_id, {CNAME} AS classifier_name, d.true_class, d.pred_class,
               tn.description AS true_label, pn.description AS pred_label, d.n, {round6('d.fraction')} AS fraction,
               CAST(round_even(d.fraction * 100, 0) AS VARCHAR) || '%' || chr(10) ||
                 CASE WHEN d.n < 1000000 THEN CAST(d.n AS VARCHAR)
                      ELSE regexp_replace(printf('%.3g', CAST(d.n AS DOUBLE)), '\\.?0+e', 'e') END AS annotation,
               d.true_class = d.pred_class AS is_diagonal,
               NOT bool_or(d.true_class = d.pred_class) OVER (PARTITION BY d.classifier_id, d.true_class)
                 AS never_predicted
        FROM dense d
        JOIN classifiers cf ON cf.classifier_id = d.classifier_id
        LEFT JOIN names tn ON tn.class_id = d.true_class
        LEFT JOIN names pn ON pn.class_id = d.pred_class""",
       {**_MISSED_CTE, "dense": _DENSE_FRAC, "names": _NAMES})

__all__ = ["oracle", "oracle_sql", "width_bucket_sql", "round6"]
