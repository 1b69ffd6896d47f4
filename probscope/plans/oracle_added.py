"""Oracle SQL of the incremental summaries, the verdicts by number of alerts and the characteristic times."""

from __future__ import annotations

from probscope.plans.oracle import _ORACLE, ORDERS, oracle
from probscope.plans.oracle_base import round6, width_bucket_sql
from probscope.plans.oracle_more import ALLROWS, CTX, EC, FMEAN, HC, PDC, _VCOLS

# a summary kept in batches is what the whole table gives
for _name, _of in {"probhist": "probhist", "confusion": "confusion_last_best", "probdiff": "probdiff_hist",
                   "relday_mean": "mean_prob_by_relday", "relday_distribution": "relday_distribution"}.items():
    _ORACLE[f"incremental_{_name}"] = _ORACLE[_of]

DETECTIONS = """
        SELECT dia_source_id, dia_object_id, row_number() OVER (PARTITION BY dia_object_id
                                                                ORDER BY mid_point_tai, dia_source_id) AS k
        FROM diasource"""
VERDICTS = f"""
        SELECT k.k, c.classifier_id, a.dia_object_id, c.class_id
        FROM (SELECT CAST(range AS INTEGER) AS k FROM range(1, 21)) k
        JOIN (SELECT dia_object_id, max(k) AS n FROM detections GROUP BY dia_object_id) o ON o.n >= k.k
        JOIN detections d ON d.dia_object_id = o.dia_object_id AND d.k <= k.k
        JOIN diaalert a ON a.dia_source_id = d.dia_source_id
        JOIN broker_message m ON m.alert_id = a.alert_id
        JOIN broker_classification c ON c.broker_message_id = m.broker_message_id
        QUALIFY row_number() OVER (PARTITION BY k.k, c.classifier_id, a.dia_object_id
                                   ORDER BY {ORDERS['best']}, c.class_id, c.broker_message_id) = 1"""
BY_ALERTS = """
        SELECT v.classifier_id, g.class_id AS true_class, v.class_id AS pred_class, v.k, count(*) AS n
        FROM verdicts v JOIN truth t ON t.dia_object_id = v.dia_object_id JOIN gentype_dim g ON g.gentype = t.gentype
        GROUP BY ALL"""
VC = {"detections": DETECTIONS, "verdicts": VERDICTS, "byalerts": BY_ALERTS}
oracle("confusion_by_alerts", "SELECT * FROM byalerts", VC)
oracle("accuracy_by_alerts", f"""
        SELECT classifier_id, true_class, k, n_objects, n_correct, {round6('n_correct / n_objects')} AS share
        FROM (SELECT classifier_id, true_class, k, CAST(sum(n) AS BIGINT) AS n_objects,
                     CAST(sum(CASE WHEN pred_class = true_class THEN n ELSE 0 END) AS BIGINT) AS n_correct
              FROM byalerts GROUP BY ALL) s""", VC)

# light curves: the highest point, and on either side the low point next to it
POINTS = """
        SELECT dia_object_id, filter_name, mid_point_tai AS t, max(ps_flux) AS flux FROM diaforcedsource GROUP BY ALL"""
PEAKS = """
        SELECT *, first_value(t) OVER w AS top, first_value(flux) OVER w / 2 AS half
        FROM points WINDOW w AS (PARTITION BY dia_object_id, filter_name ORDER BY flux DESC, t)"""
NEIGHBOURS = """
        SELECT *, lead(t) OVER w AS t1, lead(flux) OVER w AS f1, lag(t) OVER w AS t0, lag(flux) OVER w AS f0
        FROM peaks WINDOW w AS (PARTITION BY dia_object_id, filter_name ORDER BY t)"""
WIDTHS = """
        SELECT dia_object_id,
               CASE WHEN rise IS NULL THEN 2 * fall WHEN fall IS NULL THEN 2 * rise ELSE rise + fall END AS width
        FROM (SELECT dia_object_id, filter_name,
                     arg_max(top - (t + (half - flux) / (f1 - flux) * (t1 - t)), t) FILTER (t < top AND flux <= half) AS rise,
                     arg_min(t + (half - flux) / (f0 - flux) * (t0 - t) - top, t) FILTER (t > top AND flux <= half) AS fall
              FROM neighbours WHERE half > 0 GROUP BY ALL) s
        WHERE rise IS NOT NULL OR fall IS NOT NULL"""
TAUS = """
        SELECT g.class_id AS true_class_id, count(*) AS n_curves, quantile_disc(w.width, 0.5) AS tau
        FROM widths w JOIN truth t ON t.dia_object_id = w.dia_object_id JOIN gentype_dim g ON g.gentype = t.gentype
        GROUP BY ALL"""
WC = {"points": POINTS, "peaks": PEAKS, "neighbours": NEIGHBOURS, "widths": WIDTHS, "taus": TAUS}
oracle("characteristic_times", f"SELECT true_class_id, n_curves, {round6('tau')} AS tau FROM taus", WC)
SCALED_BIN = width_bucket_sql("scaled", -2.0, 6.0, 16)
oracle("mean_prob_by_scaled_time", f"""
        SELECT classifier_id, true_class_id, scaled_bin, class_id, {round6(FMEAN('probability'))} AS mean_prob, count(*) AS n,
               (scaled_bin - 1) * 0.5::DOUBLE - 1.75::DOUBLE AS scaled_time
        FROM (SELECT *, {SCALED_BIN} AS scaled_bin
              FROM (SELECT d.*, u.true_class_id, d.deltat / u.tau AS scaled
                    FROM ded d JOIN gentype_dim g ON g.gentype = d.gentype JOIN taus u ON u.true_class_id = g.class_id) x) y
        GROUP BY ALL""", {**HC, **WC})

ANSWERS = """
        SELECT a.alert_id, x.classifier_id, x.broker_message_id,
               CAST(date_diff('second', a.alert_sent_ts, x.ingest_ts) AS BIGINT) AS seconds
        FROM diaalert a
        LEFT JOIN (SELECT DISTINCT m.broker_message_id, m.alert_id, m.ingest_ts, c.classifier_id
                   FROM broker_message m JOIN broker_classification c ON c.broker_message_id = m.broker_message_id) x
          ON x.alert_id = a.alert_id AND x.ingest_ts >= a.alert_sent_ts AND x.ingest_ts <= a.alert_sent_ts + INTERVAL 20 SECOND
        WHERE a.alert_sent_ts IS NOT NULL"""
for _name in ("answers_batch", "answers_stream"):
    oracle(_name, f"""
        SELECT classifier_id, count(DISTINCT alert_id) AS n_alerts, count(broker_message_id) AS n_messages,
               {round6('avg(seconds)')} AS mean_seconds, max(seconds) AS max_seconds
        FROM answers GROUP BY classifier_id""", {"answers": ANSWERS})

oracle("prob_by_sliding_window", f"""
        SELECT c.classifier_id, g.class_id AS true_class_id, w.window, w.t0, w.t1, {round6(FMEAN('c.probability'))} AS mean_prob,
               count(*) AS n
        FROM broker_classification c JOIN ctx x ON x.broker_message_id = c.broker_message_id
        JOIN gentype_dim g ON g.gentype = x.gentype AND g.class_id = c.class_id
        JOIN (SELECT CAST(range + 1 AS INTEGER) AS window, CAST(range - 30 AS DOUBLE) AS t0, CAST(range - 20 AS DOUBLE) AS t1
              FROM range(130)) w ON x.deltat >= w.t0 AND x.deltat < w.t1
        GROUP BY ALL""", {"ctx": CTX})
oracle("deep_page", f"""
        SELECT {_VCOLS} FROM (
          SELECT *, row_number() OVER (ORDER BY dia_object_id, ingest_ts, class_id, broker_message_id) AS rn, count(*) OVER () AS n
          FROM view WHERE classifier_id = 1) v
        WHERE rn > n // 2 AND rn <= n // 2 + 1000""", {"view": EC["view"]})
_ORACLE["relday_mean_stream"] = _ORACLE["mean_prob_by_relday"]
_ORACLE["cached_probhist"] = _ORACLE["probhist"]
_ORACLE["light_curve_lookup"] = _ORACLE["light_curve"]
oracle("fractions_sum_to_one", """
        SELECT histogram, classifier_id, true_class_id, count(*) AS n_groups,
               CAST(sum(CASE WHEN abs(total - 1) <= 1e-9 THEN 1 ELSE 0 END) AS BIGINT) AS n_sum_to_one
        FROM (SELECT 'probhist' AS histogram, classifier_id, true_class_id, sum(frac) AS total FROM norm
              GROUP BY classifier_id, true_class_id, class_id, tbin
              UNION ALL
              SELECT 'probdiff_hist', classifier_id, true_class_id, sum(share) FROM (
                SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY classifier_id, true_class_id, earlytimebin, latetimebin)
                          AS share FROM pdh) p
              GROUP BY classifier_id, true_class_id, earlytimebin, latetimebin) g
        GROUP BY ALL""", {**HC, **PDC})
oracle("sketched_distinct", """
        SELECT c.classifier_id, g.class_id AS true_class_id, count(DISTINCT x.dia_object_id) AS n_objects,
               count(DISTINCT x.dia_source_id) AS n_sources, TRUE AS objects_close, TRUE AS sources_close
        FROM broker_classification c JOIN ctx x ON x.broker_message_id = c.broker_message_id
        JOIN gentype_dim g ON g.gentype = x.gentype
        GROUP BY ALL""", {"ctx": CTX})
oracle("sketched_quantiles", """
        SELECT r.classifier_id, g.class_id AS true_class_id, r.class_id, count(*) AS n, TRUE AS quartiles_close
        FROM allrows r JOIN gentype_dim g ON g.gentype = r.gentype
        WHERE r.relday BETWEEN -10 AND 10
        GROUP BY ALL""", {"ctx": CTX, "allrows": ALLROWS})
