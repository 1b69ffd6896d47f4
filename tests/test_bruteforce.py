"""Spark operators vs a plain-pandas brute force on a small, deliberately skewed fixture:
one object holds most sources, one classifier most messages, messages repeat,
probabilities tie, some alerts were never sent."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from probscope.operators import confusion as cm
from probscope.operators import probhist as ph
from probscope.operators import relday as rd
from probscope.sources import dims
from tests.literal import make_tables

CLASSES = dims.FIXTURE_CLASS_IDS
GENTYPE_CLASS = {g: c for c, g, _ in dims.EXACT_CLASSES}
PROBS = [0.0, 0.1, 0.25, 0.5, 1.0]


def _fixture(seed=7):
    rnd = random.Random(seed)
    truth, sources, alerts, messages, cls = [], [], [], [], []
    sid, mid = 100, 10_000
    for obj in range(1, 31):
        truth.append((obj, rnd.choice([10, 20, 30, 40, 50]), 1000.0))
        n_src = 60 if obj == 1 else rnd.randint(0, 3)        # object 1 is hot
        for _ in range(n_src):
            sid += 1
            mpt = 1000.0 + rnd.randint(-30, 110)              # repeated times -> id tie-break
            band = rnd.choice(["r", "g", "i"])
            sources.append((sid, obj, mpt, band))
            sent = None if rnd.random() < 0.2 else datetime(2024, 1, 1) + timedelta(days=rnd.randint(0, 5))
            alerts.append((sid + 1, sid, obj, sent))
            for _ in range(rnd.randint(1, 3)):                # repeated messages
                mid += 1
                ingest = datetime(2024, 1, 10) + timedelta(days=rnd.randint(0, 2))
                messages.append((mid, sid + 1, ingest))
                cfer = 1 if rnd.random() < 0.7 else rnd.choice([2, 3])
                for c in CLASSES:
                    cls.append((mid, cfer, c, rnd.choice(PROBS)))
    return truth, sources, alerts, messages, cls


@pytest.fixture(scope="module")
def fx(spark):
    truth, sources, alerts, messages, cls = _fixture()
    t = make_tables(spark, truth, sources, alerts, messages, cls)
    p = {
        "truth": pd.DataFrame(truth, columns=["obj", "gentype", "peak"]),
        "src": pd.DataFrame(sources, columns=["src", "obj", "mpt", "band"]),
        "alert": pd.DataFrame(alerts, columns=["alert", "src", "obj", "ts"]),
        "msg": pd.DataFrame(messages, columns=["msg", "alert", "ingest"]),
        "cls": pd.DataFrame(cls, columns=["msg", "cfer", "cls", "p"]),
    }
    p["truth"]["true"] = p["truth"]["gentype"].map(GENTYPE_CLASS)
    return t, p


def _rows(p):
    r = p["cls"].merge(p["msg"], on="msg").merge(p["alert"], on="alert")
    return r.merge(p["truth"][["obj", "true", "peak"]], on="obj")


def _first(df, keys, sort_cols, ascending):
    return df.sort_values(keys + sort_cols, ascending=[True] * len(keys) + ascending,
                          na_position="first").groupby(keys, as_index=False).first()


def _brute_last_best(p):
    r = _rows(p)
    r["ts_null"] = r["ts"].isna()
    r["ts_key"] = r["ts"].fillna(pd.Timestamp(0))
    best = _first(r, ["cfer", "obj"], ["ts_null", "ts_key", "p", "cls", "msg"], [False, False, False, True, True])
    return best


def test_last_best_confusion(fx):
    t, p = fx
    best = _brute_last_best(p)
    want = best.groupby(["cfer", "cls", "true"]).size().to_dict()
    got = {(r.classifier_id, r.pred_class, r.true_class): r.n for r in cm.confusion_counts(t, "last_best").collect()}
    assert got == want


def test_missed_confusion(fx):
    t, p = fx
    best = _brute_last_best(p)
    sent = p["alert"].groupby("obj")["ts"].apply(lambda s: s.notna().any())
    sent_objs = p["truth"][p["truth"]["obj"].map(sent).eq(True)]
    want = {}
    for cfer in [c[0] for c in dims.CLASSIFIERS]:
        b = best[best["cfer"] == cfer].set_index("obj")["cls"]
        for _, o in sent_objs.iterrows():
            pred = int(b.get(o["obj"], -1))
            want[(cfer, pred, o["true"])] = want.get((cfer, pred, o["true"]), 0) + 1
    got = {(r.classifier_id, r.pred_class, r.true_class): r.n
           for r in cm.confusion_counts(t, "last_best", include_missed=True).collect()}
    assert got == want


def test_nth_detection_confusion(fx):
    t, p = fx
    src = p["src"].sort_values(["obj", "mpt", "src"]).copy()
    src["nd"] = src.groupby("obj").cumcount() + 1
    third = set(src.loc[src["nd"] == 2, "src"])
    r = _rows(p)
    r = r[r["src"].isin(third)]
    best = _first(r, ["cfer", "obj"], ["p", "cls", "msg"], [False, True, True])
    want = best.groupby(["cfer", "cls", "true"]).size().to_dict()
    got = {(r.classifier_id, r.pred_class, r.true_class): r.n
           for r in cm.confusion_counts(t, "nth", nth_detection=2).collect()}
    assert got == want


def _width_bucket(x, lo, hi, n):
    out = np.floor(n * (x - lo) / (hi - lo)).astype(int) + 1
    return np.where(x < lo, 0, np.where(x >= hi, n + 1, out))


def test_probhist(fx):
    t, p = fx
    r = _rows(p).merge(p["src"][["src", "mpt"]], on="src")
    ded = r.groupby(["cfer", "src", "cls", "true", "mpt", "peak"], as_index=False)["p"].agg(lambda x: round(math.fsum(x) / len(x), 12))
    ded["tbin"] = _width_bucket((ded["mpt"] - ded["peak"]).to_numpy(), -30.0, 100.0, 26)
    ded["pbin"] = _width_bucket(ded["p"].to_numpy(), 0.0, 1.0, 20)
    want = ded.groupby(["cfer", "cls", "true", "tbin", "pbin"]).size().to_dict()
    got = {(r.classifier_id, r.class_id, r.true_class_id, r.tbin, r.probbin): r.n for r in ph.probhist(t).collect()}
    assert got == want


def test_mean_prob_by_relday(fx):
    t, p = fx
    r = _rows(p).merge(p["src"][["src", "mpt"]], on="src")
    pairs = r[["msg", "cfer", "src", "ingest"]].drop_duplicates()
    latest = _first(pairs, ["cfer", "src"], ["ingest", "msg"], [False, False])[["cfer", "msg"]]
    r = r.merge(latest, on=["cfer", "msg"])
    r["relday"] = np.rint(r["mpt"] - r["peak"]).astype(int)
    r = r[(r["relday"] >= -20) & (r["relday"] <= 90)]
    want = r.groupby(["cfer", "true", "relday", "cls"])["p"].mean().to_dict()
    got = {(x.classifier_id, x.true_class_id, x.relday, x.class_id): x.mean_probability
           for x in rd.prob_by_relday(t).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-9)


def test_peak_confusion_column(fx):
    t, p = fx
    r = _rows(p).merge(p["src"][["src", "mpt", "band"]], on="src")
    r = r[r["band"] == "r"].copy()
    r["absdt"] = (r["mpt"] - r["peak"]).abs()
    src_pick = _first(r[["cfer", "obj", "src", "absdt"]].drop_duplicates(), ["cfer", "obj"], ["absdt", "src"],
                      [True, True])[["cfer", "obj", "src"]]
    rr = r.merge(src_pick, on=["cfer", "obj", "src"])
    pred = _first(rr, ["cfer", "obj"], ["p", "cls"], [False, True])
    want = pred.groupby(["cfer", "true", "cls"]).size().to_dict()
    got = {(x.classifier_id, x.true_class_id, x.pred_class): x.n for x in rd.peak_confusion_column(t).collect()}
    assert got == want


def test_probdiff_hist(fx):
    from probscope.operators import probdiff as pdiff
    t, p = fx
    r = _rows(p).merge(p["src"][["src", "mpt"]], on="src")
    r = r[r["cls"] == r["true"]].copy()
    dt = r["mpt"] - r["peak"]
    bins = [(1, -99999.0, -20.0)] + [(k + 2, -20.0 + 10 * k, -10.0 + 10 * k) for k in range(12)] + [(14, 100.0, 99999.0)]
    r["tb"] = None
    for b, lo, hi in bins:
        r.loc[(dt >= lo) & (dt < hi), "tb"] = b
    mp = r.groupby(["cfer", "true", "obj", "tb"], as_index=False)["p"].max()
    pairs = mp.merge(mp, on=["cfer", "true", "obj"], suffixes=("_e", "_l"))
    pairs = pairs[pairs["tb_e"] < pairs["tb_l"]]
    d = (pairs["p_l"] - pairs["p_e"]).to_numpy()
    pairs = pairs.assign(bin=_width_bucket(d, -1.025, 1.025, 41))
    want = pairs.groupby(["cfer", "true", "tb_e", "tb_l", "bin"]).size().to_dict()
    got = {(x.classifier_id, x.true_class_id, x.earlytimebin, x.latetimebin, x.probdiffbin): x.n
           for x in pdiff.probdiff_hist(t).collect()}
    assert got == want


def test_missed_confusion_with_fan_out(fx):
    t, p = fx
    hier = {}
    for c, g, _ in dims.EXACT_CLASSES + dims.HIER_EXTRA_CLASSES:
        hier.setdefault(g, set()).add(c)
    best = _brute_last_best(p)
    sent = p["alert"].groupby("obj")["ts"].apply(lambda s: s.notna().any())
    sent_objs = p["truth"][p["truth"]["obj"].map(sent).eq(True)]
    want = {}
    for cfer in [c[0] for c in dims.CLASSIFIERS]:
        b = best[best["cfer"] == cfer].set_index("obj")["cls"]
        for _, o in sent_objs.iterrows():
            pred = int(b.get(o["obj"], -1))
            for true in hier[o["gentype"]]:
                want[(cfer, pred, true)] = want.get((cfer, pred, true), 0) + 1
    got = {(r.classifier_id, r.pred_class, r.true_class): r.n
           for r in cm.confusion_counts(t, "last_best", include_missed=True, hierarchical=True).collect()}
    assert got == want


def test_completeness_and_distinct_counts(fx):
    from probscope.operators import diagnostics as dg
    t, p = fx
    r = _rows(p)
    sent_src = set(p["alert"].loc[p["alert"]["ts"].notna(), "src"])
    got = {x.classifier_id: (x.n_sent, x.n_classified) for x in dg.completeness(t).collect()}
    for cfer in [c[0] for c in dims.CLASSIFIERS]:
        classified = set(r.loc[r["cfer"] == cfer, "src"]) & sent_src
        assert got[cfer] == (len(sent_src), len(classified))
    summ = {(x.classifier_id, x.true_class_id): (x.n_rows, x.n_sources, x.n_objects)
            for x in rd.classification_summary(t).collect()}
    want = {k: (len(g), g["src"].nunique(), g["obj"].nunique()) for k, g in r.groupby(["cfer", "true"])}
    assert summ == want


def test_dedupe_and_total_probability(fx):
    t, p = fx
    r = _rows(p)
    want_tot = r.groupby(["cfer", "src"])["p"].sum().to_dict()
    got_tot = {(x.classifier_id, x.dia_source_id): x.totprob for x in ph.totprob_per_source(t).collect()}
    assert got_tot.keys() == want_tot.keys()
    assert all(got_tot[k] == pytest.approx(v, abs=1e-8) for k, v in want_tot.items())
    want_ded = r.groupby(["cfer", "src", "cls"])["p"].agg(["mean", "size"])
    got_ded = {(x.classifier_id, x.dia_source_id, x.class_id): (x.probability, x.n_messages)
               for x in ph.dedupe_mean(t).collect()}
    assert len(got_ded) == len(want_ded)
    for k, row in want_ded.iterrows():
        assert got_ded[k][1] == row["size"] and got_ded[k][0] == pytest.approx(row["mean"], abs=1e-9)


def test_relday_distribution_and_closed_histogram(fx):
    t, p = fx
    r = _rows(p).merge(p["src"][["src", "mpt"]], on="src")
    r["relday"] = np.rint(r["mpt"] - r["peak"]).astype(int)
    g = r.groupby(["cfer", "true", "relday", "cls"])["p"]
    want = {k: (len(v), v.min(), v.max(), v.mean()) for k, v in g}
    got = {(x.classifier_id, x.true_class_id, x.relday, x.class_id):
           (x.n, x.min_probability, x.max_probability, x.mean_probability) for x in rd.relday_distribution(t).collect()}
    assert got.keys() == want.keys()
    for k, (n, lo, hi, mean) in want.items():
        assert got[k][:3] == (n, lo, hi) and got[k][3] == pytest.approx(mean, abs=1e-9)
    edges = np.linspace(0, 1, 21)
    want_h = {}
    for k, v in g:
        counts, _ = np.histogram(v.to_numpy(), bins=edges)
        for b, c in enumerate(counts, start=1):
            if c:
                want_h[(*k, b)] = int(c)
    got_h = {(x.classifier_id, x.true_class_id, x.relday, x.class_id, x.bin): x.n
             for x in rd.prob_histogram_closed(t).collect()}
    assert got_h == want_h


def test_top_classes(fx):
    t, p = fx
    means = rd.prob_by_relday(t)
    m = pd.DataFrame([r.asDict() for r in means.collect()])
    peak = (m.sort_values(["classifier_id", "true_class_id", "class_id", "mean_probability", "relday"],
                          ascending=[True, True, True, False, True])
            .groupby(["classifier_id", "true_class_id", "class_id"], as_index=False).first())
    peak = peak.sort_values(["classifier_id", "true_class_id", "mean_probability", "class_id"],
                            ascending=[True, True, False, True])
    peak["rank"] = peak.groupby(["classifier_id", "true_class_id"]).cumcount() + 1
    want = {(r.classifier_id, r.true_class_id, r.class_id): (r.rank, r.relday)
            for r in peak[peak["rank"] <= 5].itertuples()}
    got = {(r.classifier_id, r.true_class_id, r.class_id): (r.rank, r.peak_relday)
           for r in rd.top_classes(means, 5).collect()}
    assert got == want


def test_match_rate_by_level(fx):
    from probscope.operators import catalog as cat
    t, p = fx
    best = _brute_last_best(p)
    want = {}
    for level, d in (("exact", 1), ("category", 10), ("general", 100), ("broad", 1000)):
        for (cfer, true), g in best.groupby(["cfer", "true"]):
            can = g["cls"].isin([c for c, _, name in dims.EXACT_CLASSES if c >= 2000 and not name.endswith("/Other")])
            match = int((((g["cls"] // d) * d == (true // d) * d) & can).sum())
            want[(cfer, true, level)] = (len(g), match)
    got = {(r.classifier_id, r.true_class, r.level): (r.n_objects, r.n_match)
           for r in cat.match_rate_by_level(cm.confusion_counts(t, "last_best"), cat.class_catalog(t)).collect()}
    assert got == want


def test_alert_rate_and_delays(fx):
    from probscope.operators import diagnostics as dg
    t, p = fx
    sent = p["alert"].dropna(subset=["ts"])
    want_rate = sent.groupby(sent["ts"].dt.floor("D")).size().to_dict()
    got_rate = {r.window_start: r.n_alerts for r in dg.alert_rate(t).collect()}
    assert {pd.Timestamp(k): v for k, v in got_rate.items()} == {pd.Timestamp(k): v for k, v in want_rate.items()}
    r = _rows(p)[["msg", "cfer", "alert", "ts", "ingest"]].drop_duplicates(["msg", "cfer"]).dropna(subset=["ts"])
    secs = (r["ingest"] - r["ts"]).dt.total_seconds()
    want = r.assign(s=secs).groupby("cfer")["s"].agg(["size", "mean", "min", "max"])
    got = {x.classifier_id: (x.n, x.mean_seconds, x.min_seconds, x.max_seconds)
           for x in dg.delay_stats(t).collect() if x.delay == "alert_to_broker"}
    for cfer, row in want.iterrows():
        n, mean, lo, hi = got[cfer]
        assert (n, lo, hi) == (row["size"], row["min"], row["max"]) and mean == pytest.approx(row["mean"])


def test_probhist_with_fan_out(fx):
    t, p = fx
    hier = {}
    for c, g, _ in dims.EXACT_CLASSES + dims.HIER_EXTRA_CLASSES:
        hier.setdefault(g, set()).add(c)
    r = _rows(p).merge(p["src"][["src", "mpt"]], on="src").merge(p["truth"][["obj", "gentype"]], on="obj")
    ded = r.groupby(["cfer", "src", "cls", "gentype", "mpt", "peak"], as_index=False)["p"].agg(
        lambda x: round(math.fsum(x) / len(x), 12))
    ded["tbin"] = _width_bucket((ded["mpt"] - ded["peak"]).to_numpy(), -30.0, 100.0, 26)
    ded["pbin"] = _width_bucket(ded["p"].to_numpy(), 0.0, 1.0, 20)
    want = {}
    for row in ded.itertuples():
        for true in hier[row.gentype]:
            k = (row.cfer, row.cls, true, row.tbin, row.pbin)
            want[k] = want.get(k, 0) + 1
    got = {(x.classifier_id, x.class_id, x.true_class_id, x.tbin, x.probbin): x.n
           for x in ph.probhist(t, hierarchical=True).collect()}
    assert got == want


def test_object_and_source_listings(fx):
    t, p = fx
    r = _rows(p)
    want_src = set(map(tuple, r[["cfer", "true", "src"]].drop_duplicates().to_numpy().tolist()))
    got_src = {(x.classifier_id, x.true_class_id, x.dia_source_id) for x in rd.source_summary(t).collect()}
    assert got_src == want_src
    want_obj = set(map(tuple, r[["cfer", "true", "obj"]].drop_duplicates().to_numpy().tolist()))
    got_obj = {(x.classifier_id, x.true_class_id, x.dia_object_id) for x in rd.object_summary(t).collect()}
    assert got_obj == want_obj


def test_message_arrays_roundtrip_and_argmax(fx):
    from probscope.operators import reshape as rs
    t, p = fx
    msgs = rs.messages_as_arrays(t.broker_classification)
    back = {tuple(r) for r in rs.explode_messages(msgs).collect()}
    assert back == {tuple(r) for r in p["cls"][["msg", "cfer", "cls", "p"]].itertuples(index=False)}
    best = _first(p["cls"], ["msg", "cfer"], ["p", "cls"], [False, True])
    want = {(r.msg, r.cfer): r.cls for r in best.itertuples()}
    got = {(r.broker_message_id, r.classifier_id): r.class_id for r in rs.argmax_from_array(msgs).collect()}
    assert got == want
