"""Personal data: generated candidates, boosted trees, calibrated thresholds.

The base rules find addresses, IPs, cards and phones in their plain written form.
Beside them, generators of high recall propose overlapping spans in looser forms
(phones without a plus, cards and IPs with other separators, addresses with the
at and the dots spelt out). Boosted trees score each proposal by its format and
the words around it, and a threshold per kind, the lowest one at which the
held-out part of the training rows reaches ``PRECISION``, selects what is added.

The trees learn from the corpus itself: all spans of the base rules in all documents (equal ones with equal context once) are
rewritten in loose forms (label 1) and replaced by dates, versions, amounts, order numbers and digits that break the
checks (label 0), each in the place where the span stood. A third of them, by a hash of the value, is held out, so that
copies of one value are on one side. Without any span nothing is added. Proposals of equal score are taken in order of
their place in the text.

A null text is an empty one, empty texts have no spans, texts are searched whole,
rows with equal or null ids are searched one by one, further columns are not read
and an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probscope.llm.boosting import Booster
from probscope.llm.common import ddl, slices, whole_texts, written

KINDS = ("email", "ip", "card", "phone")
#: Spans of a kind up to which each is rewritten several times.
FEW_SPANS = 1_500
#: Rows of equal features that a task of a training pass reads.
ROWS_A_TASK = 20_000
PRECISION = 0.98
SCORES = 10_000
#: Characters on either side of a span that the trees may look at.
CONTEXT = 24

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: kind -> pattern of its loose forms, and what a text must hold for it to be tried
LOOSE = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:@|[(\[{]at[)\]}]| at ) ?[A-Za-z0-9-]{1,63}"
                         r"(?: ?(?:\.|[(\[{]dot[)\]}]| dot ) ?[A-Za-z0-9-]{2,24}){1,4}"), re.compile("@|dot")),
    "ip": (re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?(?:[.,:]|[(\[{]\.?(?:dot)?[)\]}]) ?[0-9]{1,3}){3}(?![0-9])"), None),
    "card": (re.compile(r"(?<![0-9])[0-9]{3,6}(?:[ ./_-]{1,2}[0-9]{3,6}){2,4}(?![0-9])"), None),
    "phone": (re.compile(r"(?<![0-9+])(?:\(0?[0-9]{2,4}\)|0{0,2}[0-9]{2,4})[ ./-]{1,2}[0-9]{3,4}"
                         r"(?:[ ./-]{1,2}[0-9]{2,5}){1,3}(?![0-9])"), None),
}
WORDS = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|ping)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|payment)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|call|fax|mobile|cell)\b"),
    "other": re.compile(r"(?i)\b(?:version|v|no|number|order|isbn|id|date|section|page)\b\.?"),
}


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in parts))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses. Each at sign is looked at once, so that long runs of letters cost no more."""
    begin, at = 0, text.find("@")
    while at >= 0:
        run = text[begin:at]
        start = begin + len(run.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        begin = found.end() if found else at + 1
        at = text.find("@", begin)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the base rules, by kind and start."""
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if octets(m.group().split("."))]
    for m in CARD.finditer(text):
        if 13 <= len(number := digits(m.group())) <= 19 and luhn(number):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return out


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Loose candidates of every kind; they may overlap each other and the base spans."""
    return [(kind, *m.span()) for kind, (pattern, needs) in LOOSE.items() if not needs or needs.search(text)
            for m in pattern.finditer(text)]


def features(kind: str, value: str, before: str, after: str) -> list[float]:
    """Format and context of a candidate."""
    number = digits(value)
    groups = re.findall("[0-9]+", value)
    lengths = [len(g) for g in groups] or [0]
    tail = re.split(r"[^A-Za-z0-9-]+", value.rstrip(")]} "))[-1]
    mail = kind == "email"
    return [
        KINDS.index(kind), len(value), len(number), sum(c.isalpha() for c in value),
        *(value.count(c) for c in " -./(,:+_["), len(groups), lengths[0], lengths[-1], max(lengths), min(lengths),
        len(number) > 1 and luhn(number), len(groups) == 4 and octets(groups),
        bool(groups) and len(groups[0]) == 4 and groups[0][:2] in ("19", "20"),
        len(set(number)), value.startswith("0"),
        mail and bool(re.search(r"[(\[{](?:at|dot)[)\]}]", value)), mail and "@" in value,
        mail and len(re.findall(r"\bdot\b", value)), mail and len(tail), mail and tail.isalpha(),
        mail and bool(re.search(r"[._0-9]", value.split("@")[0].split(" at ")[0].split("(")[0].split("[")[0])),
        before[-1:].isalnum(), after[:1].isalnum(), before[-1:] in tuple("$€£#."), after[:1] == "%",
        *(bool(w.search(before)) for w in WORDS.values()),
    ]


@dataclass
class Model:
    trees: Booster | None = None
    thresholds: dict[str, float] = field(default_factory=dict)


def loose_forms(kind: str, value: str, rng: random.Random) -> list[str]:
    """The same personal data as people also write it."""
    if kind == "email":
        name, _, host = value.partition("@")
        dots = rng.choice(["(dot)", "[dot]", " dot "])
        at = {"(dot)": "(at)", "[dot]": "[at]", " dot ": " at "}[dots]
        return [name + at + host.replace(".", dots), f"{name} {at.strip()} {host.replace('.', f' {dots.strip()} ')}"]
    if kind == "ip":
        return [value.replace(".", "[.]"), value.replace(".", rng.choice(["(dot)", "[dot]"]))]
    if kind == "card":
        number = digits(value)
        parts = [number[i:i + 4] for i in range(0, len(number), 4)]
        return [rng.choice([".", "/", "_", "  "]).join(parts if len(parts[-1]) > 2 else
                                                       [*parts[:-2], parts[-2] + parts[-1]])]
    number = digits(value)[-10:]
    a, b, c = number[:3], number[3:6], number[6:]
    return [f"({a}) {b}-{c}", rng.choice(["{}-{}-{}", "{}.{}.{}", "{} {} {}"]).format(a, b, c)]


def other_numbers(kind: str, value: str, rng: random.Random) -> list[tuple[str, str]]:
    """(word before or nothing, text) that looks alike but is no personal data."""
    n = rng.randrange
    year, month, day = n(1900, 2100), n(1, 13), n(1, 29)
    if kind == "email":
        return [("", f"{rng.choice(['look', 'meet', 'stop'])} at {rng.choice(['the', 'home', 'this'])} dot here"),
                ("", f"@{rng.choice(['app', 'test'])}.route"[1:].replace(".", " @ x"))]
    if kind == "ip":
        return [("version ", f"{n(1, 20)}.{n(100)}.{n(100)}.{n(100)}".replace(".", ", ")),
                ("", f"{n(256, 999)}[.]{n(256, 999)}[.]{n(999)}[.]{n(999)}"),
                ("", f"{n(24):02}:{n(60):02}:{n(60):02}:{n(100):02}"),
                ("", f"{n(1000)}, {n(1000)}, {n(1000)}, {n(1000)}")]
    if kind == "card":
        number = digits(value)
        wrong = number[:-1] + str((int(number[-1]) + n(1, 10)) % 10)
        return [("", rng.choice([".", "/", "_"]).join(wrong[i:i + 4] for i in range(0, 16, 4))),
                ("", " ".join(f"{n(1000):03}" for _ in range(n(3, 6)))),
                ("", f"{n(10**6):06}/{n(10**6):06}/{n(1000):03}")]
    return [("", f"{year}-{month:02}{day:02}-{n(100):02}"), ("", f"{day:02}-{year}-{n(1000):03}"),
            ("order ", f"{n(100, 999)}/{n(10**4):04}/{n(100):02}"), ("", f"{year}/{n(1000, 9999)}/{n(10, 99)}"),
            ("", " ".join([f"{n(1, 100):02}", *(f"{n(1000):03}" for _ in range(n(2, 4)))])),
            ("", f"{n(10, 99)}.{n(100, 999)}.{n(100, 999)}")]


def training_rows(kind: str, value: str, before: str, after: str, times: int) -> Iterator[tuple[list[float], float, bool]]:
    """(features, label, held out) from one base span, rewritten ``times`` times."""
    rng = random.Random(zlib.crc32("\0".join((kind, value, before, after)).encode()))
    held = zlib.crc32(value.encode()) % 3 == 0
    for _ in range(times):
        texts = [("", v, 1.0) for v in loose_forms(kind, value, rng)]
        texts += [(w, v, 0.0) for w, v in other_numbers(kind, value, rng)]
        for word, text, label in texts:
            for k, (pattern, _) in LOOSE.items():
                if m := pattern.search(text):
                    yield (features(k, m.group(), before + word + text[:m.start()], text[m.end():] + after),
                           label if k == kind else 0.0, held)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Trees and thresholds from all different spans of ``docs``. Rows of equal features are counted, every pass of
    the training runs over all of them in Spark, and what comes to the driver is bounded by bins."""

    def spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(k, t[a:b], t[max(0, a - CONTEXT):a], t[b:b + CONTEXT])
                    for t in batch.column("text").to_pylist() for k, a, b in base_spans(t)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in list(zip(*rows)) or [()] * 4],
                                             ["kind", "value", "before", "after"])

    texts = whole_texts(docs, id_col, text_col)
    spans = written(texts.mapInArrow(spans_of, "kind string, value string, before string, after string").distinct(), "pii-spans")
    # few spans are rewritten several times each
    times = {r.kind: min(10, -(-FEW_SPANS // r.n)) for r in spans.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "value", 1 << 14):
            rows = [r for s in zip(*(c.to_pylist() for c in batch.columns)) for r in training_rows(*s, times[s[0]])]
            x, y, held = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array([[float(v) for v in f] for f in x], pa.list_(pa.float64())),
                                              pa.array(y, pa.float64()), pa.array(held, pa.bool_())], ["x", "y", "held"])

    rows = spans.mapInArrow(rows_of, "x array<double>, y double, held boolean")
    rows = written(rows.groupBy("x", "y", "held").agg(F.count(F.lit(1)).alias("n")), "pii-rows")
    # every task of a pass sends its sums, so the tasks follow from the rows, not from the partitions of the shuffle
    rows = written(rows.coalesce(-(-rows.count() // ROWS_A_TASK) or 1), "pii-rows")
    if rows.select("y").distinct().count() < 2:
        return Model()
    trees = Booster().fit_frame(rows.where(~F.col("held")).select("x", "y", "n"))
    return Model(trees, _thresholds(rows.where("held").select("x", "y", "n"), trees))


def _thresholds(held: DataFrame, trees: Booster) -> dict[str, float]:
    """kind -> the lowest edge of ``SCORES`` equal bins of the score from which on ``PRECISION`` is reached."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n")
            x = batch.column("x").flatten().to_numpy().reshape(len(n), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[:, 0].astype(int)), pa.array(np.floor(trees.predict(x) * SCORES).astype(int)), batch.column("y"), n],
                ["kind", "bin", "y", "n"])

    bins = held.mapInArrow(run, "kind long, bin long, y double, n long").groupBy("kind", "bin").agg(
        F.sum(F.col("y") * F.col("n")).alias("ones"), F.sum("n").alias("n")).collect()
    thresholds = {}
    for i, kind in enumerate(KINDS):
        mine = sorted(((r.bin, r.ones, r.n) for r in bins if r.kind == i), reverse=True)
        ones, n = np.cumsum([r[1] for r in mine]), np.cumsum([r[2] for r in mine])
        good = [r[0] / SCORES for r, a, b in zip(mine, ones, n) if a >= PRECISION * b and r[1] > 0]
        if good:
            thresholds[kind] = max(0.5, good[-1])
    return thresholds


def find_spans(texts: list[str], model: Model) -> list[list[tuple[str, int, int, bool, float]]]:
    """(kind, start, end, of the base rules, score) of each text. Added spans overlap no other span."""
    out, asked, rows = [], [], []
    for i, text in enumerate(texts):
        base = base_spans(text)
        out.append([(*s, True, 1.0) for s in base])
        if model.trees:
            for kind, a, b in proposals(text):
                if kind in model.thresholds and not any(a < e and s < b for _, s, e in base):
                    asked.append((i, kind, a, b))
                    rows.append(features(kind, text[a:b], text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]))
    if rows:
        scores = model.trees.predict(np.array(rows, float))
        taken: dict[int, list[tuple[int, int]]] = {}
        for j in sorted(range(len(asked)), key=lambda j: (-scores[j], asked[j][0], asked[j][2], asked[j][3], asked[j][1])):
            i, kind, a, b = asked[j]
            mine = taken.setdefault(i, [])
            if scores[j] >= model.thresholds[kind] and not any(a < e and s < b for s, e in mine):
                mine.append((a, b))
                out[i].append((kind, a, b, False, float(scores[j])))
    order = {k: i for i, k in enumerate(KINDS)}
    return [sorted(spans, key=lambda s: (order[s[0]], s[1])) for spans in out]


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"


def redacted(text: str, spans: list[tuple[str, int, int, bool, float]]) -> str:
    """``text`` with each stretch of overlapping spans replaced by the kind that begins it."""
    out, done = [], 0
    for kind, a, b, _, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def detect(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
           redact: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, spans), with ``redact`` also ``redacted``, the text without them, and the columns
    ``keep`` of the input; a row for every row."""
    keep = list(keep)
    names = ["doc_id", "spans", *["redacted"] * redact, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = list(zip(("kind", "start", "end", "base", "score"),
                          (pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.float64())))
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            found = find_spans(texts, model)
            spans = pa.array([[dict(zip([n for n, _ in fields], s)) for s in x] for x in found],
                             pa.list_(pa.struct(fields)))
            columns = [batch.column("doc_id"), spans]
            if redact:
                columns.append(pa.array([redacted(t, s) for t, s in zip(texts, found)], pa.string()))
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in keep)], names)

    texts = whole_texts(docs, id_col, text_col, keep)
    return texts.mapInArrow(run, ", ".join([f"doc_id long, spans {SPANS}", *["redacted string"] * redact,
                                            *[ddl(texts, keep)] * bool(keep)]))


def digest_columns(spans: Column) -> list[Column]:
    """Counts of the base spans by kind, their digest, and all spans as text."""
    base = F.filter(spans, lambda s: s["base"])

    def text(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                      s["end"].cast("string"))), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    counts = [of(k).alias(f"n_{k}") for k in KINDS]
    return [*counts, F.sha2(text(base), 256).alias("base_sha256"), text(spans).alias("spans")]
