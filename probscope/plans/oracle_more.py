"""Oracle SQL for the histogram, probability-difference, relday, catalogue and
exploration families (DuckDB dialect)."""

from __future__ import annotations

from probscope.plans.oracle import _inner, chosen_sql, oracle
from probscope.sources import dims
from probscope.plans.oracle_base import round6, width_bucket_sql

D = "CAST({} AS DOUBLE)".format


def FSUM(x: str) -> str:
    return f"fsum({x})"  # a sum with error compensation


def FMEAN(x: str) -> str:
    return f"favg({x})"


TBIN = width_bucket_sql("deltat", -30.0, 100.0, 26)
# a mean within 1e-12 of a bin's edge counts as on it
PROBBIN = width_bucket_sql("(floor(probability * CAST(1e12 AS DOUBLE) + 0.5) / CAST(1e12 AS DOUBLE))", 0.0, 1.0, 20)


def probbin_val(b: str) -> str:
    cb = f"least(greatest(CAST({b} AS DOUBLE), {D(0.0)}), {D(21.0)})"
    return (f"(CASE WHEN {cb} = 0.0 THEN {D(-1.0)} WHEN {cb} = 21.0 THEN {D(1.0)} "
            f"ELSE ({cb} - {D(1.0)}) * {D(0.05)} + {D(0.025)} END)")


def tbin_val(b: str) -> str:
    cb = f"least(greatest(CAST({b} AS DOUBLE), {D(0.0)}), {D(27.0)})"
    return f"(({cb} - {D(1.0)}) * {D(5.0)} + {D(-30.0)} + {D(2.5)})"


CTX = """
        SELECT m.broker_message_id, m.alert_id, m.ingest_ts, a.dia_source_id, a.dia_object_id,
               a.alert_sent_ts, s.mid_point_tai - t.peakmjd AS deltat, t.gentype, s.filter_name
        FROM broker_message m
        JOIN diaalert a ON a.alert_id = m.alert_id
        JOIN diasource s ON s.dia_source_id = a.dia_source_id
        JOIN truth t ON t.dia_object_id = s.dia_object_id"""
DED = f"""
        SELECT c.classifier_id, x.dia_source_id, c.class_id, {FMEAN("c.probability")} AS probability,
               count(*) AS n_messages, x.deltat, x.gentype
        FROM broker_classification c JOIN ctx x ON x.broker_message_id = c.broker_message_id
        GROUP BY c.classifier_id, x.dia_source_id, c.class_id, x.deltat, x.gentype"""


def _hist(dim: str) -> str:
    return f"""
        SELECT d.classifier_id, d.class_id, g.class_id AS true_class_id, {TBIN} AS tbin, {PROBBIN} AS probbin,
               count(*) AS n
        FROM ded d JOIN {dim} g ON g.gentype = d.gentype
        GROUP BY ALL"""


HIST = _hist("gentype_dim")
NORM = """
        SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY classifier_id, true_class_id, class_id, tbin) AS frac
        FROM hist"""
# probbin 1 counts as probability 0
EXPECTED = f"""
        SELECT classifier_id, true_class_id, tbin, class_id,
               fsum(frac * CASE WHEN probbin = 1 THEN 0.0 ELSE {probbin_val("probbin")} END) AS prob
        FROM norm GROUP BY ALL"""
HC = {"ctx": CTX, "ded": DED, "hist": HIST, "norm": NORM, "expected": EXPECTED}

oracle("dedupe_mean", f"""
        SELECT classifier_id, dia_source_id, class_id, {round6('probability')} AS probability, n_messages
        FROM ded""", HC)

TOTPROB = f"""
        SELECT c.classifier_id, a.dia_source_id, {FSUM("c.probability")} AS totprob
        FROM broker_classification c
        JOIN broker_message m ON m.broker_message_id = c.broker_message_id
        JOIN diaalert a ON a.alert_id = m.alert_id
        GROUP BY ALL"""
oracle("totprob_per_source", f"SELECT classifier_id, dia_source_id, {round6('totprob')} AS totprob FROM tot",
       {"tot": TOTPROB})
oracle("totprob_audit", f"""
        SELECT classifier_id, count(*) AS n_pairs,
               {round6('avg(CASE WHEN totprob > 1.001 THEN 1.0 ELSE 0.0 END)')} AS share_above,
               {round6('avg(CASE WHEN totprob < 0.999 THEN 1.0 ELSE 0.0 END)')} AS share_below
        FROM tot GROUP BY classifier_id""", {"tot": TOTPROB})
oracle("prob_sum_check", f"""
        SELECT classifier_id, count(*) AS n_messages,
               CAST(sum(CASE WHEN abs(total - 1.0) <= 1e-6 THEN 1 ELSE 0 END) AS BIGINT) AS n_sum_to_one,
               {round6('min(total)')} AS min_total, {round6('max(total)')} AS max_total
        FROM (SELECT broker_message_id, classifier_id, {FSUM("probability")} AS total
              FROM broker_classification GROUP BY ALL) m
        GROUP BY classifier_id""")

oracle("probhist", "SELECT classifier_id, class_id, true_class_id, tbin, probbin, CAST(n AS BIGINT) AS n FROM hist", HC)
oracle("probhist_hier", "SELECT classifier_id, class_id, true_class_id, tbin, probbin, CAST(n AS BIGINT) AS n FROM h2",
       {**HC, "h2": _hist("gentype_hier")})
oracle("probhist_normalized", f"""
        SELECT classifier_id, class_id, true_class_id, tbin, probbin, CAST(n AS BIGINT) AS n,
               {round6('frac')} AS frac FROM norm""", HC)
oracle("probhist_top_merged", """
        SELECT classifier_id, true_class_id, class_id, tbin, least(probbin, 20) AS probbin, CAST(sum(n) AS BIGINT) AS n
        FROM hist GROUP BY ALL""", HC)
oracle("expected_prob_by_tbin", f"""
        SELECT classifier_id, true_class_id, tbin, class_id, {round6('prob')} AS prob,
               CASE WHEN tbin <= 0 THEN '<-30.0' WHEN tbin >= 27 THEN '≥100.0'
                    ELSE CAST({tbin_val('tbin')} AS VARCHAR) END AS tbin_label
        FROM expected""", HC)
oracle("expected_prob_heatmap", "SELECT classifier_id, true_class_id, class_id, "
       + ", ".join(f"{round6(f'max(CASE WHEN tbin = {k} THEN prob END)')} AS tbin_{k}" for k in range(28))
       + " FROM expected GROUP BY ALL", HC)
oracle("lost_probability", f"""
        SELECT classifier_id, true_class_id, tbin,
               {round6('list_reduce(list_prepend(CAST(0.0 AS DOUBLE), list_sort(list(prob))), lambda a, b: a + b)')}
                 AS total_prob
        FROM expected GROUP BY ALL""", HC)
oracle("prob_violin_table", f"""
        SELECT n.classifier_id, n.true_class_id, n.tbin, n.class_id, n.probbin,
               {round6(probbin_val('n.probbin'))} AS prob, {round6('n.frac')} AS frac,
               {round6('n.frac * 0.4')} AS half_width
        FROM norm n JOIN confusion_classes cc ON cc.true_class_id = n.true_class_id AND cc.class_id = n.class_id
        WHERE n.tbin IN (5, 7, 13, 19, 27)""", HC)
oracle("tbin_counts", f"""
        SELECT classifier_id, true_class_id, tbin, CAST(sum(n) AS BIGINT) AS n, {round6(tbin_val('tbin'))} AS t
        FROM hist GROUP BY ALL""", HC)
oracle("mean_prob_by_tbin", f"""
        SELECT d.classifier_id, g.class_id AS true_class_id, {TBIN} AS tbin, d.class_id,
               {round6(FMEAN('d.probability'))} AS mean_prob, count(*) AS n
        FROM ded d JOIN gentype_dim g ON g.gentype = d.gentype
        GROUP BY ALL""", HC)

# ---------------------------------------------------------------- probability differences
DIFFBIN = width_bucket_sql("probdiff", -1.025, 1.025, 41)
MP = """
        SELECT c.classifier_id, g.class_id AS true_class_id, x.dia_object_id, tb.timebin, max(c.probability) AS maxprob
        FROM broker_classification c
        JOIN ctx x ON x.broker_message_id = c.broker_message_id
        JOIN gentype_dim g ON g.gentype = x.gentype AND g.class_id = c.class_id
        JOIN timebins tb ON x.deltat >= tb.dtmin AND x.deltat < tb.dtmax
        GROUP BY ALL"""
PD = """
        SELECT e.classifier_id, e.true_class_id, e.dia_object_id, e.timebin AS earlytimebin,
               l.timebin AS latetimebin, l.maxprob - e.maxprob AS probdiff
        FROM mp e JOIN mp l ON l.classifier_id = e.classifier_id AND l.true_class_id = e.true_class_id
                            AND l.dia_object_id = e.dia_object_id AND e.timebin < l.timebin"""
PDH = f"""
        SELECT classifier_id, true_class_id, earlytimebin, latetimebin, {DIFFBIN} AS probdiffbin, count(*) AS n
        FROM pd GROUP BY ALL"""
BINMEAN = "(CAST(-1.025 AS DOUBLE) + CAST(0.025 AS DOUBLE) + CAST(probdiffbin - 1 AS DOUBLE) * CAST(0.05 AS DOUBLE))"
PICK = """
        SELECT a.dia_object_id, count(*) AS n
        FROM broker_classification c
        JOIN broker_message m ON m.broker_message_id = c.broker_message_id
        JOIN diaalert a ON a.alert_id = m.alert_id
        JOIN truth t ON t.dia_object_id = a.dia_object_id
        JOIN gentype_dim g ON g.gentype = t.gentype
        WHERE c.classifier_id = 1
        GROUP BY a.dia_object_id
        ORDER BY n DESC, a.dia_object_id ASC
        OFFSET 2 LIMIT 1"""
PDC = {"ctx": CTX, "mp": MP, "pd": PD, "pdh": PDH, "pick": PICK}

oracle("max_prob_by_timebin", f"""
        SELECT classifier_id, true_class_id, dia_object_id, timebin, {round6('maxprob')} AS maxprob FROM mp""", PDC)
oracle("probdiff_all_objects", f"""
        SELECT classifier_id, true_class_id, dia_object_id, earlytimebin, latetimebin,
               {round6('probdiff')} AS probdiff FROM pd""", PDC)
oracle("probdiff_for_object", f"""
        SELECT p.classifier_id, p.true_class_id, p.dia_object_id, p.earlytimebin, tbe.dtmin AS earlytimet0,
               tbe.dtmax AS earlytimet1, p.latetimebin, tbl.dtmin AS latetimet0, tbl.dtmax AS latetimet1,
               {round6('p.probdiff')} AS probdiff
        FROM pd p
        JOIN timebins tbe ON tbe.timebin = p.earlytimebin
        JOIN timebins tbl ON tbl.timebin = p.latetimebin
        WHERE p.dia_object_id IN (SELECT dia_object_id FROM pick)""", PDC)
oracle("probdiff_hist", f"""
        SELECT h.classifier_id, h.true_class_id, h.earlytimebin, tbe.dtmin AS earlytimet0, tbe.dtmax AS earlytimet1,
               h.latetimebin, tbl.dtmin AS latetimet0, tbl.dtmax AS latetimet1, h.probdiffbin,
               {round6(BINMEAN)} AS binmeanprobdiff, h.n,
               {round6('CAST(h.n AS DOUBLE) / sum(h.n) OVER (PARTITION BY h.classifier_id, h.true_class_id, h.earlytimebin, h.latetimebin)')} AS frac
        FROM pdh h
        JOIN timebins tbe ON tbe.timebin = h.earlytimebin
        JOIN timebins tbl ON tbl.timebin = h.latetimebin""", PDC)
FILLED = f"""
        SELECT g.classifier_id, g.true_class_id, g.earlytimebin, g.latetimebin, b.probdiffbin,
               {round6(BINMEAN.replace('probdiffbin', 'b.probdiffbin'))} AS binmeanprobdiff, CAST(coalesce(h.n, 0) AS BIGINT) AS n,
               {round6('coalesce(CAST(h.n AS DOUBLE) / sum(h.n) OVER (PARTITION BY g.classifier_id, g.true_class_id, g.earlytimebin, g.latetimebin), 0.0)')} AS frac
        FROM (SELECT DISTINCT classifier_id, true_class_id, earlytimebin, latetimebin FROM pdh) g
        CROSS JOIN (SELECT CAST(range AS BIGINT) AS probdiffbin FROM range(1, 42)) b
        LEFT JOIN pdh h ON h.classifier_id = g.classifier_id AND h.true_class_id = g.true_class_id
                        AND h.earlytimebin = g.earlytimebin AND h.latetimebin = g.latetimebin
                        AND h.probdiffbin = b.probdiffbin"""
oracle("probdiff_hist_filled", FILLED, PDC)
oracle("probdiff_hist_inner", f"SELECT * FROM ({FILLED}) f WHERE probdiffbin BETWEEN 2 AND 40", PDC)

# ---------------------------------------------------------------- relday family
def closed_bin_sql(x: str, lo, hi, n: int) -> str:
    """numpy.histogram bin (1-based) on linspace edges, last bin closed; NULL outside."""
    lo_s = D(lo) if isinstance(lo, float) else f"CAST({lo} AS DOUBLE)"
    hi_s = D(hi) if isinstance(hi, float) else f"CAST({hi} AS DOUBLE)"
    step = f"(({hi_s} - {lo_s}) / {D(float(n))})"
    edges = " + ".join(f"(CASE WHEN {x} >= {lo_s} + {D(float(i))} * {step} THEN 1 ELSE 0 END)" for i in range(1, n))
    return f"(CASE WHEN {x} >= {lo_s} AND {x} <= {hi_s} THEN CAST(1 + {edges} AS BIGINT) END)"


RELDAY = "CAST(round_even(deltat, 0) AS INTEGER)"
LATEST = """
        SELECT broker_message_id, classifier_id, deltat, gentype FROM (
          SELECT p.broker_message_id, p.classifier_id, x.deltat, x.gentype,
                 row_number() OVER (PARTITION BY p.classifier_id, x.dia_source_id
                                    ORDER BY x.ingest_ts DESC NULLS LAST, p.broker_message_id DESC) AS rn
          FROM (SELECT DISTINCT broker_message_id, classifier_id FROM broker_classification) p
          JOIN ctx x ON x.broker_message_id = p.broker_message_id) q
        WHERE rn = 1"""
BYDAY = f"""
        SELECT c.classifier_id, g.class_id AS true_class_id, {RELDAY.replace('deltat', 'l.deltat')} AS relday,
               c.class_id, {FMEAN("c.probability")} AS mean_probability, max(c.probability) AS max_probability,
               count(*) AS n
        FROM broker_classification c
        JOIN latest l ON l.broker_message_id = c.broker_message_id AND l.classifier_id = c.classifier_id
        JOIN gentype_dim g ON g.gentype = l.gentype
        WHERE {RELDAY.replace('deltat', 'l.deltat')} BETWEEN -20 AND 90
        GROUP BY ALL"""
TOP5 = """
        SELECT classifier_id, true_class_id, class_id, peak_probability, peak_relday, CAST(rank AS INTEGER) AS rank
        FROM (
          SELECT *, row_number() OVER (PARTITION BY classifier_id, true_class_id
                                       ORDER BY peak_probability DESC, class_id ASC) AS rank
          FROM (SELECT classifier_id, true_class_id, class_id, mean_probability AS peak_probability,
                       relday AS peak_relday
                FROM (SELECT *, row_number() OVER (PARTITION BY classifier_id, true_class_id, class_id
                                                   ORDER BY mean_probability DESC, relday ASC) AS r1
                      FROM byday) a WHERE r1 = 1) b) c
        WHERE rank <= 5"""
RC = {"ctx": CTX, "latest": LATEST, "byday": BYDAY, "top5": TOP5}
oracle("mean_prob_by_relday", f"""
        SELECT classifier_id, true_class_id, relday, class_id, {round6('mean_probability')} AS mean_probability, n
        FROM byday""", RC)
oracle("max_prob_by_relday", f"""
        SELECT classifier_id, true_class_id, relday, class_id, {round6('max_probability')} AS max_probability, n
        FROM byday""", RC)
oracle("top5_classes", f"""
        SELECT classifier_id, true_class_id, class_id, {round6('peak_probability')} AS peak_probability,
               peak_relday, rank FROM top5""", RC)
oracle("top5_curves", f"""
        SELECT b.classifier_id, b.true_class_id, b.class_id, t.rank, b.relday,
               {round6('b.mean_probability')} AS mean_probability
        FROM byday b JOIN top5 t ON t.classifier_id = b.classifier_id AND t.true_class_id = b.true_class_id
                                AND t.class_id = b.class_id""", RC)

CSRC = """
        SELECT DISTINCT c.classifier_id, a.dia_source_id
        FROM broker_classification c
        JOIN broker_message m ON m.broker_message_id = c.broker_message_id
        JOIN diaalert a ON a.alert_id = m.alert_id"""
CHOSEN = """
        SELECT classifier_id, dia_object_id, dia_source_id, deltat, gentype FROM (
          SELECT cs.classifier_id, s.dia_object_id, s.dia_source_id, s.mid_point_tai - t.peakmjd AS deltat, t.gentype,
                 row_number() OVER (PARTITION BY cs.classifier_id, s.dia_object_id
                                    ORDER BY abs(s.mid_point_tai - t.peakmjd), s.dia_source_id) AS rn
          FROM csrc cs
          JOIN diasource s ON s.dia_source_id = cs.dia_source_id
          JOIN truth t ON t.dia_object_id = s.dia_object_id
          WHERE s.filter_name = 'r') q
        WHERE rn = 1"""
PRED = """
        SELECT classifier_id, dia_object_id, class_id, gentype FROM (
          SELECT ch.classifier_id, ch.dia_object_id, c.class_id, ch.gentype,
                 row_number() OVER (PARTITION BY ch.classifier_id, ch.dia_object_id
                                    ORDER BY c.probability DESC, c.class_id ASC) AS rn
          FROM chosen ch
          JOIN diaalert a ON a.dia_source_id = ch.dia_source_id
          JOIN broker_message m ON m.alert_id = a.alert_id
          JOIN broker_classification c ON c.broker_message_id = m.broker_message_id
                                       AND c.classifier_id = ch.classifier_id) q
        WHERE rn = 1"""
PKC = {"csrc": CSRC, "chosen": CHOSEN, "pred": PRED}
oracle("peak_confusion_column", f"""
        SELECT classifier_id, true_class_id, pred_class, n,
               {round6('CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY classifier_id, true_class_id) AS DOUBLE) * 100.0')} AS percent
        FROM (SELECT p.classifier_id, g.class_id AS true_class_id, p.class_id AS pred_class, count(*) AS n
              FROM pred p JOIN gentype_dim g ON g.gentype = p.gentype
              GROUP BY ALL) q""", PKC)
oracle("closest_to_peak_stats", f"""
        SELECT ch.classifier_id, g.class_id AS true_class_id, count(*) AS n_objects,
               {round6('avg(ch.deltat)')} AS mean_deltat, {round6('sqrt(avg(ch.deltat * ch.deltat))')} AS rms_deltat
        FROM chosen ch JOIN gentype_dim g ON g.gentype = ch.gentype
        GROUP BY ALL""", PKC)

ALLROWS = f"""
        SELECT c.classifier_id, c.class_id, c.probability, x.gentype, x.dia_source_id, x.dia_object_id,
               {RELDAY.replace('deltat', 'x.deltat')} AS relday
        FROM broker_classification c JOIN ctx x ON x.broker_message_id = c.broker_message_id"""
oracle("relday_distribution", f"""
        SELECT r.classifier_id, g.class_id AS true_class_id, r.relday, r.class_id, count(*) AS n,
               {round6('min(r.probability)')} AS min_probability, {round6('max(r.probability)')} AS max_probability,
               {round6(FMEAN('r.probability'))} AS mean_probability
        FROM allrows r JOIN gentype_dim g ON g.gentype = r.gentype
        GROUP BY ALL""", {"ctx": CTX, "allrows": ALLROWS})
oracle("prob_histogram_closed", f"""
        SELECT classifier_id, true_class_id, relday, class_id, bin, count(*) AS n FROM (
          SELECT r.classifier_id, g.class_id AS true_class_id, r.relday, r.class_id,
                 {closed_bin_sql('r.probability', 0.0, 1.0, 20)} AS bin
          FROM allrows r JOIN gentype_dim g ON g.gentype = r.gentype) q
        WHERE bin IS NOT NULL
        GROUP BY ALL""", {"ctx": CTX, "allrows": ALLROWS})
SOURCES = """
        SELECT cs.classifier_id, g.class_id AS true_class_id, s.dia_object_id, s.dia_source_id, s.filter_name,
               s.mid_point_tai - t.peakmjd AS deltat
        FROM csrc cs
        JOIN diasource s ON s.dia_source_id = cs.dia_source_id
        JOIN truth t ON t.dia_object_id = s.dia_object_id
        JOIN gentype_dim g ON g.gentype = t.gentype"""
oracle("source_summary", SOURCES, PKC)
oracle("tight_json_sources", SOURCES, PKC)
oracle("object_summary", """
        SELECT o.classifier_id, g.class_id AS true_class_id, o.dia_object_id, t.gentype, t.peakmjd
        FROM (SELECT DISTINCT cs.classifier_id, s.dia_object_id FROM csrc cs
              JOIN diasource s ON s.dia_source_id = cs.dia_source_id) o
        JOIN truth t ON t.dia_object_id = o.dia_object_id
        JOIN gentype_dim g ON g.gentype = t.gentype""", PKC)
oracle("classification_summary", """
        SELECT r.classifier_id, g.class_id AS true_class_id, count(*) AS n_rows,
               count(DISTINCT r.dia_source_id) AS n_sources, count(DISTINCT r.dia_object_id) AS n_objects
        FROM allrows r JOIN gentype_dim g ON g.gentype = r.gentype
        GROUP BY ALL""", {"ctx": CTX, "allrows": ALLROWS})

# ---------------------------------------------------------------- exploration
VIEW = """
        SELECT c.classifier_id, a.dia_object_id, a.dia_source_id, c.class_id, m.alert_id, g.class_id AS true_class_id,
               c.probability, m.ingest_ts, a.alert_sent_ts, c.broker_message_id
        FROM broker_classification c
        JOIN broker_message m ON m.broker_message_id = c.broker_message_id
        JOIN diaalert a ON a.alert_id = m.alert_id
        JOIN truth t ON t.dia_object_id = a.dia_object_id
        JOIN gentype_dim g ON g.gentype = t.gentype"""
PICKED = """
        SELECT p.dia_object_id, p.n AS n_classifications, g.class_id AS true_class_id
        FROM pick p JOIN truth t ON t.dia_object_id = p.dia_object_id JOIN gentype_dim g ON g.gentype = t.gentype"""
EC = {"view": VIEW, "pick": PICK, "picked": PICKED}
_VCOLS = "classifier_id, dia_object_id, class_id, alert_id, true_class_id, " + round6("probability") + " AS probability, ingest_ts, alert_sent_ts"
oracle("page_offset_limit", f"""
        SELECT {_VCOLS} FROM view WHERE classifier_id = 1
        ORDER BY dia_object_id, ingest_ts, class_id, broker_message_id OFFSET 2000 LIMIT 1000""", EC)
oracle("third_richest_object", "SELECT * FROM picked", EC)
oracle("object_prob_history", f"""
        SELECT v.classifier_id, v.dia_object_id, v.class_id, v.alert_id, v.true_class_id, {round6("v.probability")} AS probability,
               v.alert_sent_ts, s.mid_point_tai
        FROM view v JOIN diasource s ON s.dia_source_id = v.dia_source_id
        WHERE v.dia_object_id IN (SELECT dia_object_id FROM picked) AND v.class_id = v.true_class_id""", EC)
oracle("light_curve", """
        SELECT dia_object_id, mid_point_tai, ps_flux, ps_flux_err, filter_name FROM diaforcedsource
        WHERE dia_object_id IN (SELECT dia_object_id FROM picked)""", EC)
oracle("classifications_with_deltat", f"""
        SELECT v.classifier_id, v.dia_object_id, v.class_id, v.alert_id, v.true_class_id, {round6("v.probability")} AS probability,
               v.alert_sent_ts, s.mid_point_tai - t.peakmjd AS deltat
        FROM view v JOIN diasource s ON s.dia_source_id = v.dia_source_id
        JOIN truth t ON t.dia_object_id = v.dia_object_id
        WHERE v.classifier_id IN (SELECT classifier_id FROM classifiers WHERE broker_name = 'Aster')
          AND v.true_class_id = 2222""", EC)
oracle("first_classifications", f"""
        SELECT classifier_id, dia_object_id, class_id, alert_id, true_class_id, {round6("probability")} AS probability,
               alert_sent_ts, deltat
        FROM (SELECT v.*, s.mid_point_tai - t.peakmjd AS deltat
              FROM view v JOIN diasource s ON s.dia_source_id = v.dia_source_id
              JOIN truth t ON t.dia_object_id = v.dia_object_id
              WHERE v.true_class_id = 2222
              ORDER BY v.dia_object_id NULLS FIRST, v.alert_sent_ts NULLS LAST, v.broker_message_id, v.class_id
              LIMIT 10000) q""", EC)
oracle("predicate_rows", f"""
        SELECT classifier_id, true_class_id, class_id, alert_id, broker_message_id, {round6("probability")} AS probability
        FROM view WHERE probability >= 0.25 AND class_id <> true_class_id AND alert_sent_ts IS NOT NULL""", EC)
oracle("prob_matrix_pivot", "SELECT classifier_id, dia_object_id, deltat, " + ", ".join(
    f"{round6(f'avg(CASE WHEN class_id = {c} THEN bin_prob END)')} AS class_{c}"
    for c in sorted({c for c, *_ in dims.EXACT_CLASSES + dims.HIER_EXTRA_CLASSES})) + """,
               count(*) FILTER (class_id NOT IN (SELECT class_id FROM gentype_hier)) AS n_other
        FROM (SELECT v.classifier_id, v.dia_object_id, v.class_id, s.mid_point_tai - t.peakmjd AS deltat,
                     round_even(v.probability * 100.0, 0) / 100.0 AS bin_prob
              FROM view v JOIN diasource s ON s.dia_source_id = v.dia_source_id
              JOIN truth t ON t.dia_object_id = v.dia_object_id
              WHERE v.dia_object_id IN (SELECT dia_object_id FROM picked)) q
        GROUP BY classifier_id, dia_object_id, deltat""", EC)
SEMI = """
        SELECT v.classifier_id, v.dia_object_id, v.class_id, v.alert_id, v.probability, v.alert_sent_ts,
               s.mid_point_tai, t.peakmjd, s.mid_point_tai - t.peakmjd AS deltat, v.true_class_id
        FROM view v JOIN diasource s ON s.dia_source_id = v.dia_source_id
        JOIN truth t ON t.dia_object_id = v.dia_object_id
        WHERE v.dia_object_id IN (SELECT dia_object_id FROM truth
                                  WHERE gentype IN (SELECT gentype FROM gentype_hier WHERE class_id = 2222))
          AND v.class_id = 2222"""
oracle("semi_join_class_objects", f"""
        SELECT classifier_id, dia_object_id, class_id, alert_id, {round6('probability')} AS probability, alert_sent_ts,
               mid_point_tai, peakmjd, deltat, true_class_id FROM semi_rows""", {**EC, "semi_rows": SEMI})
TRUE_ROWS = """
        SELECT v.classifier_id, v.dia_object_id, v.true_class_id, v.probability, s.mid_point_tai - t.peakmjd AS deltat
        FROM view v JOIN diasource s ON s.dia_source_id = v.dia_source_id
        JOIN truth t ON t.dia_object_id = v.dia_object_id
        WHERE v.class_id = v.true_class_id"""
oracle("naive_tbin_mean", f"""
        SELECT classifier_id, true_class_id, CAST(floor((deltat + 20.0) / 5.0) AS BIGINT) AS tbin,
               {round6(FMEAN('probability'))} AS mean_prob, count(*) AS n
        FROM true_rows GROUP BY ALL""", {**EC, "true_rows": TRUE_ROWS})
oracle("object_weighted_tbin_mean", f"""
        SELECT classifier_id, true_class_id, tbin, {round6(FMEAN('p'))} AS mean_prob, count(*) AS n
        FROM (SELECT classifier_id, true_class_id, CAST(floor((deltat + 20.0) / 5.0) AS BIGINT) AS tbin, dia_object_id,
                     {FMEAN('probability')} AS p
              FROM true_rows GROUP BY ALL) q
        GROUP BY ALL""", {**EC, "true_rows": TRUE_ROWS})
oracle("class_histogram10", f"""
        SELECT r.classifier_id, b.bin,
               {round6('r.lo + CAST(b.bin - 1 AS DOUBLE) * ((r.hi - r.lo) / 10.0)')} AS bin_lo,
               {round6('CASE WHEN b.bin = 10 THEN r.hi ELSE r.lo + CAST(b.bin AS DOUBLE) * ((r.hi - r.lo) / 10.0) END')} AS bin_hi,
               CAST(coalesce(h.n, 0) AS BIGINT) AS n
        FROM rng r
        CROSS JOIN (SELECT CAST(range AS BIGINT) AS bin FROM range(1, 11)) b
        LEFT JOIN (SELECT c.classifier_id, {closed_bin_sql('CAST(c.class_id AS DOUBLE)', 'r.lo', 'r.hi', 10)} AS bin,
                          count(*) AS n
                   FROM broker_classification c JOIN rng r ON r.classifier_id = c.classifier_id
                   GROUP BY ALL) h ON h.classifier_id = r.classifier_id AND h.bin = b.bin""",
       {"rng": """
        SELECT classifier_id,
               CASE WHEN min(class_id) = max(class_id) THEN CAST(min(class_id) AS DOUBLE) - 0.5
                    ELSE CAST(min(class_id) AS DOUBLE) END AS lo,
               CASE WHEN min(class_id) = max(class_id) THEN CAST(max(class_id) AS DOUBLE) + 0.5
                    ELSE CAST(max(class_id) AS DOUBLE) END AS hi
        FROM broker_classification GROUP BY classifier_id"""})

# ---------------------------------------------------------------- catalogue
USED = """
        SELECT DISTINCT class_id FROM broker_classification
        UNION
        SELECT g.class_id FROM (SELECT DISTINCT gentype FROM truth) t JOIN gentype_hier g ON g.gentype = t.gentype"""
CATALOG = """
        SELECT u.class_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_classifications, d.description
        FROM used u
        LEFT JOIN (SELECT class_id, count(*) AS n FROM broker_classification GROUP BY class_id) c
               ON c.class_id = u.class_id
        LEFT JOIN (SELECT class_id, min(description) AS description FROM gentype_hier GROUP BY class_id) d
               ON d.class_id = u.class_id"""
LEVEL = """CASE WHEN NOT (class_id >= 2000) OR description LIKE '%/Other' THEN 'none' WHEN class_id < 1000 THEN 'none'
                WHEN class_id % 1000 = 0 THEN 'broad' WHEN class_id % 100 = 0 THEN 'general'
                WHEN class_id % 10 = 0 THEN 'category' ELSE 'exact' END"""
LEVELS = f"""
        SELECT class_id, level, level = 'exact' AS exactmatch, level = 'category' AS categorymatch,
               level = 'general' AS generalmatch, level = 'broad' AS broadmatch
        FROM (SELECT class_id, {LEVEL} AS level FROM catalog) q"""
CC = {"used": USED, "catalog": CATALOG, "levels": LEVELS}
oracle("class_catalog", "SELECT * FROM catalog", CC)
oracle("taxonomy_order", """
        SELECT class_id, description,
               CAST(rpad(CAST(class_id AS VARCHAR),
                         CAST((SELECT max(length(CAST(class_id AS VARCHAR))) FROM catalog) AS INTEGER), '0') AS BIGINT) AS sort_key
        FROM catalog
        UNION ALL SELECT -1, 'missed', -1""", CC)
oracle("match_level", "SELECT * FROM levels", CC)
oracle("match_rate_by_level", f"""
        SELECT classifier_id, true_class, level, CAST(sum(n) AS BIGINT) AS n_objects,
               CAST(sum(CASE WHEN pred_class >= 0 AND CAST(floor(pred_class / d) * d AS INTEGER)
                                  = CAST(floor(true_class / d) * d AS INTEGER) THEN n ELSE 0 END) AS BIGINT) AS n_match,
               {round6('sum(CASE WHEN pred_class >= 0 AND CAST(floor(pred_class / d) * d AS INTEGER) = CAST(floor(true_class / d) * d AS INTEGER) THEN n ELSE 0 END) / sum(n)')} AS rate
        FROM matchable
        CROSS JOIN (VALUES ('exact', 1), ('category', 10), ('general', 100), ('broad', 1000)) lv(level, d)
        GROUP BY ALL""", {**CC,"best": chosen_sql("last_best"),
                          "counts": """
        SELECT b.classifier_id, b.class_id AS pred_class, g.class_id AS true_class, count(*) AS n
        FROM truth t JOIN gentype_dim g ON t.gentype = g.gentype JOIN best b ON b.dia_object_id = t.dia_object_id
        GROUP BY ALL""", "matchable": """
        SELECT c.classifier_id, c.true_class, c.n, CASE WHEN l.level = 'none' THEN -1 ELSE c.pred_class END AS pred_class
        FROM counts c LEFT JOIN levels l ON l.class_id = c.pred_class"""})
CFSTATS = """
        SELECT classifier_id, count(*) AS n_messages, sum(c) AS n_classifications
        FROM (SELECT broker_message_id, classifier_id, count(*) AS c FROM broker_classification GROUP BY ALL) m
        GROUP BY classifier_id"""
oracle("classifier_catalog", """
        SELECT cf.classifier_id, cf.broker_name, cf.broker_version, cf.classifier_name, cf.classifier_params,
               coalesce(cf.broker_name, 'None') || ' ' || coalesce(cf.broker_version, 'None') || ' ' ||
               coalesce(cf.classifier_name, 'None') || ' ' || coalesce(cf.classifier_params, 'None') AS title,
               concat_ws('  ', rpad(coalesce(cf.broker_name, 'None'), CAST(greatest(20, length(coalesce(cf.broker_name, 'None'))) AS INTEGER), ' '),
                         rpad(coalesce(cf.classifier_name, 'None'), CAST(greatest(32, length(coalesce(cf.classifier_name, 'None'))) AS INTEGER), ' '),
                         rpad(coalesce(cf.broker_version, 'None'), CAST(greatest(16, length(coalesce(cf.broker_version, 'None'))) AS INTEGER), ' '),
                         rpad(coalesce(cf.classifier_params, 'None'), CAST(greatest(12, length(coalesce(cf.classifier_params, 'None'))) AS INTEGER), ' '))
                 AS sort_key,
               CAST(coalesce(s.n_messages, 0) AS BIGINT) AS n_messages,
               CAST(coalesce(s.n_classifications, 0) AS BIGINT) AS n_classifications
        FROM classifiers cf LEFT JOIN cfstats s ON s.classifier_id = cf.classifier_id""", {"cfstats": CFSTATS})
oracle("catalog_from_json", """
        SELECT l.class_id, c.description, l.exactmatch, l.categorymatch, l.generalmatch, l.broadmatch, g.gentypes
        FROM levels l JOIN catalog c ON c.class_id = l.class_id
        LEFT JOIN (SELECT class_id, string_agg(CAST(gentype AS VARCHAR), ',' ORDER BY gentype) AS gentypes
                   FROM (SELECT DISTINCT class_id, gentype FROM gentype_hier) q GROUP BY class_id) g
               ON g.class_id = l.class_id""", CC)
oracle("classifier_catalog_json", """
        SELECT c.classifier_id, c.broker_name, c.broker_version, c.classifier_name, c.classifier_params,
               CAST(coalesce(s.n_messages, 0) AS BIGINT) AS n_messages
        FROM classifiers c LEFT JOIN cfstats s ON s.classifier_id = c.classifier_id""", {"cfstats": CFSTATS})
oracle("tight_json_rows", f"""
        SELECT classifier_id, true_class_id, relday, class_id, {round6('mean_probability')} AS mean_probability, n
        FROM byday""", RC)
oracle("summary_partition_roundtrip", f"""
        SELECT classifier_id, true_class_id, relday, class_id, {round6('mean_probability')} AS mean_probability, n
        FROM byday""", RC)

# ---------------------------------------------------------------- service diagnostics, I/O, arrays
ALERT_RATE = """
        SELECT date_trunc('day', alert_sent_ts) AS window_start,
               date_trunc('day', alert_sent_ts) + INTERVAL 1 DAY AS window_end, count(*) AS n_alerts
        FROM diaalert WHERE alert_sent_ts IS NOT NULL GROUP BY ALL"""
oracle("alert_rate", ALERT_RATE)
oracle("alert_rate_stream", ALERT_RATE)
# An alert is sent, the broker publishes a message on it, the service takes the message in.
DELAYS = """
        SELECT p.classifier_id, k.delay,
               CASE k.delay WHEN 'alert_to_broker' THEN epoch(m.broker_ts) - epoch(a.alert_sent_ts)
                            WHEN 'broker_to_ingest' THEN epoch(m.ingest_ts) - epoch(m.broker_ts)
                            ELSE epoch(m.ingest_ts) - epoch(a.alert_sent_ts) END::BIGINT AS seconds
        FROM (SELECT DISTINCT broker_message_id, classifier_id FROM broker_classification) p
        JOIN broker_message m ON m.broker_message_id = p.broker_message_id
        JOIN diaalert a ON a.alert_id = m.alert_id
        CROSS JOIN (VALUES ('alert_to_broker'), ('broker_to_ingest'), ('alert_to_ingest')) k(delay)
        WHERE a.alert_sent_ts IS NOT NULL"""
oracle("delay_stats", f"""
        SELECT classifier_id, delay, count(*) AS n, {round6('avg(seconds)')} AS mean_seconds,
               min(seconds) AS min_seconds, max(seconds) AS max_seconds, quantile_disc(seconds, 0.25) AS q25_seconds,
               quantile_disc(seconds, 0.5) AS q50_seconds, quantile_disc(seconds, 0.75) AS q75_seconds
        FROM delays GROUP BY ALL""", {"delays": DELAYS})
oracle("completeness", f"""
        SELECT cf.classifier_id, (SELECT count(DISTINCT dia_source_id) FROM diaalert WHERE alert_sent_ts IS NOT NULL)
                 AS n_sent,
               CAST(coalesce(k.n, 0) AS BIGINT) AS n_classified,
               {round6('coalesce(CAST(coalesce(k.n, 0) AS DOUBLE) / (SELECT count(DISTINCT dia_source_id) FROM diaalert WHERE alert_sent_ts IS NOT NULL), 0.0)')} AS completeness
        FROM classifiers cf
        LEFT JOIN (SELECT cs.classifier_id, count(*) AS n FROM csrc cs
                   WHERE cs.dia_source_id IN (SELECT dia_source_id FROM diaalert WHERE alert_sent_ts IS NOT NULL)
                   GROUP BY cs.classifier_id) k ON k.classifier_id = cf.classifier_id""", PKC)
oracle("prob_by_detection", f"""
        SELECT v.classifier_id, v.true_class_id, d.detection, {round6(FMEAN('v.probability'))} AS mean_prob,
               count(*) AS n
        FROM view v
        JOIN (SELECT dia_source_id, row_number() OVER (PARTITION BY dia_object_id
                                                       ORDER BY mid_point_tai, dia_source_id) AS detection
              FROM diasource) d ON d.dia_source_id = v.dia_source_id
        WHERE v.class_id = v.true_class_id
        GROUP BY ALL""", EC)
oracle("csv_roundtrip", _inner("last_best"), {"best": chosen_sql("last_best")})
oracle("parameterised_sql", f"""
        SELECT v.classifier_id, v.dia_object_id, v.class_id, v.alert_id, v.true_class_id,
               {round6('v.probability')} AS probability, s.mid_point_tai - t.peakmjd AS deltat
        FROM view v JOIN diasource s ON s.dia_source_id = v.dia_source_id
        JOIN truth t ON t.dia_object_id = v.dia_object_id
        WHERE v.classifier_id IN (1, 2, 3, 4) AND v.true_class_id = 2223""", EC)
oracle("explode_messages", f"""
        SELECT broker_message_id, classifier_id, class_id, {round6('probability')} AS probability
        FROM broker_classification""")
oracle("argmax_from_array", f"""
        SELECT broker_message_id, classifier_id, class_id, {round6('probability')} AS probability FROM (
          SELECT *, row_number() OVER (PARTITION BY broker_message_id, classifier_id
                                       ORDER BY probability DESC, class_id ASC) AS rn
          FROM broker_classification) q
        WHERE rn = 1""")

oracle("delay_histogram", """
        SELECT classifier_id, delay, CAST(floor(seconds / 86400) * 86400 AS BIGINT) AS bin_start_seconds, count(*) AS n
        FROM delays GROUP BY ALL""", {"delays": DELAYS})
oracle("classifications_relday", f"""
        SELECT r.classifier_id, g.class_id AS true_class_id, r.dia_source_id, r.class_id, r.relday,
               {round6('r.probability')} AS probability
        FROM allrows r JOIN gentype_dim g ON g.gentype = r.gentype""", {"ctx": CTX, "allrows": ALLROWS})
oracle("json_rows_roundtrip", "SELECT alert_id, dia_source_id, dia_object_id, alert_sent_ts FROM diaalert")

oracle("relday_quantiles", f"""
        SELECT classifier_id, true_class_id, relday, class_id, {round6('qs[1]')} AS q25, {round6('qs[2]')} AS q50,
               {round6('qs[3]')} AS q75
        FROM (SELECT r.classifier_id, g.class_id AS true_class_id, r.relday, r.class_id,
                     quantile_disc(r.probability, [0.25, 0.5, 0.75]) AS qs
              FROM allrows r JOIN gentype_dim g ON g.gentype = r.gentype
              GROUP BY ALL) q""", {"ctx": CTX, "allrows": ALLROWS})
