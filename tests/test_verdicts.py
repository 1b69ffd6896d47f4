"""Verdicts after k alerts against a plain loop, across buckets, and characteristic times against one per curve."""

from collections import Counter, defaultdict
from statistics import median_low

import pytest
from pyspark.sql import functions as F

from probscope.operators import characteristic as ch
from probscope.operators import confusion as cm
from probscope.operators import verdicts as vd


def plain_verdicts(t, most):
    sources = defaultdict(list)
    for r in t.diasource.collect():
        sources[r.dia_object_id].append((r.mid_point_tai, r.dia_source_id))
    ordinal = {s: k for o in sources for k, (_, s) in enumerate(sorted(sources[o]), 1)}
    alerts = {r.alert_id: r for r in t.diaalert.collect()}
    message = {r.broker_message_id: r.alert_id for r in t.broker_message.collect()}
    rows = defaultdict(list)
    for r in t.broker_classification.collect():
        a = alerts[message[r.broker_message_id]]
        sent = (1, 0) if a.alert_sent_ts is None else (0, a.alert_sent_ts.timestamp())
        place = (r.probability, sent, -r.class_id, -r.broker_message_id)
        rows[r.classifier_id, a.dia_object_id].append((ordinal[a.dia_source_id], place, r.class_id))
    gentype = {r.dia_object_id: r.gentype for r in t.truth.collect()}
    classes = defaultdict(list)
    for r in t.gentype.collect():
        classes[r.gentype].append(r.class_id)
    out = Counter()
    for (classifier, obj), found in rows.items():
        for k in range(1, min(len(sources[obj]), most) + 1):
            so_far = [(p, c) for d, p, c in found if d <= k]
            if so_far:
                for true in classes[gentype[obj]]:
                    out[classifier, true, max(so_far)[1], k] += 1
    return out


@pytest.mark.parametrize("most,span", [(20, 1000), (20, 2), (3, 1), (10 ** 6, 3)])
def test_confusion_by_alerts(tables, most, span, monkeypatch):
    monkeypatch.setattr(vd, "SPAN", span)
    got = vd.confusion_by_alerts(tables, None if most > 1000 else most).collect()
    got = {(r.classifier_id, r.true_class, r.pred_class, r.k): r.n for r in got}
    assert got == dict(plain_verdicts(tables, most)) and len({k[3] for k in got}) >= 3


def test_last_verdict_is_the_best(tables):
    """After all alerts the verdict is the class that ``best`` chooses."""
    n = tables.diasource.groupBy("dia_object_id").agg(F.count("*").alias("n"))
    last = (vd.verdict_changes(tables).join(n, "dia_object_id").where("change = -1 and k = n + 1")
            .select("classifier_id", "dia_object_id", "class_id"))
    best = cm.chosen_classification(tables, "best").select("classifier_id", "dia_object_id", "class_id")
    assert sorted(last.collect()) == sorted(best.collect())


def crossing(a, b, half):
    return a[0] + (half - a[1]) / (b[1] - a[1]) * (b[0] - a[0])


def plain_width(points):
    best = {}
    for t, f in points:
        best[t] = max(best.get(t, f), f)
    points = sorted(best.items())
    top, high = min(points, key=lambda p: (-p[1], p[0]))
    half = high / 2
    if half <= 0:
        return None
    rise = fall = None
    for a, b in zip(points, points[1:]):
        if b[0] <= top and a[1] <= half < b[1]:
            rise = top - crossing(a, b, half)  # the last one counts
        if a[0] >= top and b[1] <= half < a[1] and fall is None:
            fall = crossing(b, a, half) - top
    if rise is None and fall is None:
        return None
    return 2 * fall if rise is None else 2 * rise if fall is None else rise + fall


def test_half_widths(spark):
    curves = {
        1: [(0.0, 0.0), (10.0, 10.0), (20.0, 0.0)],                       # a triangle: half its base
        2: [(0.0, 1.0), (4.0, 8.0), (6.0, 8.0), (8.0, 7.0), (12.0, 2.0), (15.0, 1.0)],  # the earlier of two maxima
        3: [(0.0, 9.0), (5.0, 4.0), (6.0, 1.0)],                         # one side
        4: [(0.0, 9.0), (5.0, 8.0)],                                     # no side
        5: [(0.0, -9.0), (5.0, -1.0)],                                   # no positive flux
        6: [(3.0, 5.0)],
        7: [(0.0, 1.0), (1.0, 9.0), (1.0, 3.0), (2.0, 5.0), (3.0, 4.0), (4.0, 6.0), (9.0, 0.0)],  # two points of one time
    }
    data = [(o, t, f, 0.1, "r") for o, c in curves.items() for t, f in c]
    data += [(8, None, 5.0, 0.1, "r"), (8, 1.0, None, 0.1, "r"), (8, 2.0, float("nan"), 0.1, "r")]
    frame = spark.createDataFrame(data, "dia_object_id long, mid_point_tai double, ps_flux double, ps_flux_err double, "
                                        "filter_name string")

    class T:
        diaforcedsource = frame

    got = {r.dia_object_id: r.width for r in ch.half_widths(ch.curve_points(T)).collect()}
    want = {o: w for o, c in curves.items() if (w := plain_width(c)) is not None}
    assert set(got) == set(want) == {1, 2, 3, 7} and got[1] == 10.0
    assert all(abs(got[o] - want[o]) < 1e-12 for o in want)


def test_characteristic_times(tables):
    curves = defaultdict(list)
    for r in tables.diaforcedsource.collect():
        curves[r.dia_object_id, r.filter_name].append((r.mid_point_tai, r.ps_flux))
    gentype = {r.dia_object_id: r.gentype for r in tables.truth.collect()}
    classes = {r.gentype: r.class_id for r in tables.gentype.collect()}
    widths = defaultdict(list)
    for (o, _), points in curves.items():
        if (w := plain_width(points)) is not None and gentype[o] in classes:
            widths[classes[gentype[o]]].append(w)
    got = {r.true_class_id: (r.n_curves, r.tau) for r in ch.characteristic_times(tables).collect()}
    assert got.keys() == widths.keys() and len(got) >= 5
    for c, ws in widths.items():
        assert got[c][0] == len(ws) and abs(got[c][1] - median_low(ws)) < 1e-9


def test_messages_are_read_once(tables):
    """What the counts are made from comes from files of its own, not from the messages each time."""
    plan = vd.confusion_by_alerts(tables, 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "first" in plan and "probs" not in plan
