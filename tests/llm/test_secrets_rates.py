"""The randomness tests of secrets: encodings, p of random strings, and the rate of accepted names."""

import random
import string

import pytest

from probscope.llm import secrets

SCHEMA = "uid long, start int, end int, value string"
ALNUM = string.ascii_letters + string.digits


def run_on(spark, values):
    rows = [(i, 0, len(v), v) for i, v in enumerate(values)]
    return secrets.tested(spark.createDataFrame(rows, SCHEMA).repartition(8)).toPandas().set_index("uid").sort_index()


def test_encodings(spark):
    """Every alphabet is the class of its own characters, each of them; the first that has all is taken."""
    rows = [(name, c * 3) for name, letters in secrets.ENCODINGS.items() for c in letters]
    rows = [(n, (letters := secrets.ENCODINGS[n]) + c + letters) for n, c in rows]
    df = spark.createDataFrame(rows, "name string, text string")
    got = df.select("name", secrets.inferred(df.text).alias("found")).distinct().collect()
    assert sorted((r.name, r.found) for r in got) == sorted((n, n) for n in secrets.ENCODINGS)
    rng = random.Random(1)
    some = ["".join(rng.choices(ALNUM, k=20)) for _ in range(400)]
    some = [s for s in some if set(s) & set(string.digits) and not s.islower() and not s.isupper()]
    df = spark.createDataFrame([(s,) for s in some], "text string")
    assert {r.e for r in df.select(secrets.inferred(df.text).alias("e")).collect()} == {"alphanumeric"}


@pytest.mark.parametrize("n", [16, 40])
def test_p_is_uniform(spark, n):
    rng = random.Random(n)
    values, own = [], []
    for name in ("hex", "base32", "alphanumeric", "base64"):
        for _ in range(1200):
            v = "".join(rng.choices(secrets.ENCODINGS[name], k=n))
            if set(v) & set(string.ascii_uppercase + string.digits) and set(v) & set(string.ascii_letters):
                values.append(v)
                own.append(name)
    got = run_on(spark, values)
    got["own"] = own
    same = got[got.own == got.encoding]
    for name, p in same.groupby("own").p:
        m = len(p)
        assert m > 400
        for at in (0.05, 0.1, 0.25, 0.5, 0.75, 0.9):  # four standard errors of the sample and of the made one
            assert abs((p < at).mean() - at) < 4 * (at * (1 - at) * (1 / m + 1 / 2000)) ** 0.5, (name, at)


WORDS = ("get set find user name list item http page load save open read write order value count index table query node tree path "
         "file data test main view model event class field batch cache stream buffer thread client server config parser").split()


def test_rate_of_names(spark):
    """Of the accepted strings hardly more than RATE are names, whatever the mixture, and most keys are found."""
    rng = random.Random(5)

    def name():
        s = ""
        while len(s) < 18:
            s += rng.choice(WORDS).capitalize()
        return s[0].lower() + s[1:18] + str(rng.randrange(10, 100))

    values, marks = [], []
    for i, share in enumerate((0.8, 0.5, 0.2)):
        keys = ["".join(rng.choices(ALNUM, k=20)) for _ in range(int(2500 * share))]
        names = [name() for _ in range(2500 - len(keys))]
        values += keys + names
        marks += [(i, True)] * len(keys) + [(i, False)] * len(names)
    got = run_on(spark, values)
    got["mix"], got["key"] = zip(*marks)
    for i in range(3):
        part = got[(got.mix == i) & (got.encoding == "alphanumeric")]
        rows = spark.createDataFrame(part[["encoding", "band", "string", "p"]])
        least = secrets.thresholds(rows.dropDuplicates(["encoding", "band", "string"])).collect()[0].least
        taken = part[part.p >= least]
        rate = 1 - taken.key.mean()
        assert rate <= secrets.RATE + 2 * (0.05 * 0.95 / len(taken)) ** 0.5 + 0.01, (i, rate)
        # names of 20 characters reach p of 0.15 and more, so that this rate costs keys
        assert taken.key.sum() / part.key.sum() > (0.88, 0.8, 0.75)[i], i
