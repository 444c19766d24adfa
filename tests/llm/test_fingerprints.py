"""Document fingerprints: edits, order, additivity and likeness against plain Python."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripmart.llm import fingerprints as fp


def edited(rows):
    """doc_id order, then text; the next of the last is the first."""
    rows = sorted(((-2 ** 63 if i is None else i, i, t or "") for i, t in rows), key=lambda r: (r[0], r[2].encode()))
    out = []
    for k, (_, i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][2]
        q = len(t) // 4
        out.append((i, t, t[:len(t) - q] + following[:q], following))
    return out


def units(t):
    return Counter(tuple(w[i:i + fp.WIDTH]) for line in t.split("\n") for w in [line.split(" ")] for i in range(len(w)))


def dice(a, b):
    a, b = units(a), units(b)
    return 2 * sum(n * b[u] for u, n in a.items()) / (sum(n * n for n in a.values()) + sum(n * n for n in b.values()))


def words(r, n):
    return " ".join(f"w{r.randint(0, 9999)}é" + r.choice(["", "", "", "\n"]) for _ in range(n))


def test_against_plain_python(spark):
    r = random.Random(8)
    rows = [(i * i * 37, words(r, r.choice([1, 5, 40, 300]))) for i in range(60)]
    rows += [(50, ""), (51, None), (None, "no id"), (7, "same"), (7, "same"), (-400, "négative 🙂🙂🙂🙂🙂"), (1 << 40, "far away one")]
    rows += [(8000 + i, words(r, 20)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"b": F.lit(1), "rn": F.lit(2), "units": F.lit("x"), "at": F.lit(0)})
    got = fp.edited_fingerprints(docs).collect()
    want = edited(rows)
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((x.doc_id, x.n_chars, x.edited_sha256) for x in got), key=key) == sorted(((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in want), key=key)
    by = {(x.doc_id, x.edited_sha256): x for x in got}
    for i, t, e, following in want:
        x = by[i, hashlib.sha256(e.encode()).hexdigest()]
        assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1
        assert x.near_edited == pytest.approx(dice(t, e), abs=0.35)
        assert x.near_next == pytest.approx(dice(t, following), abs=0.4)
        if t == e:
            assert x.fingerprint == x.edited_fingerprint and x.near_edited == 1
        elif Counter(t.split("\n")) != Counter(e.split("\n")):
            assert x.fingerprint != x.edited_fingerprint


@pytest.mark.parametrize("hot", [1, 50, 5000])
def test_repeated_ids(spark, monkeypatch, hot):
    """A third without id, a third of one id, many equal rows, in buckets split by ranges or not."""
    monkeypatch.setattr(fp, "HOT", hot)
    monkeypatch.setattr(fp, "RANGE_ROWS", 20)
    monkeypatch.setattr(fp, "BLOCK", 7)
    r = random.Random(5)
    rows = [(None, words(r, 6)) for _ in range(150)] + [(None, "again\nand again") for _ in range(60)]
    rows += [(9, "one start " * 20 + words(r, 3)) for _ in range(40)] + [(9, None) for _ in range(30)] + [(9, "")]
    rows += [(i * 50, words(r, 8)) for i in range(80)] + [(3950, "last") for _ in range(25)]
    r.shuffle(rows)
    got = fp.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = edited(rows)
    assert Counter((x.doc_id, x.n_chars, x.edited_sha256) for x in got) == Counter((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in want)
    by = {(x.doc_id, x.edited_sha256): x for x in got}
    for i, t, e, following in want:
        x = by[i, hashlib.sha256(e.encode()).hexdigest()]
        assert x.near_edited == pytest.approx(dice(t, e), abs=0.35)
    same = [x for x in got if x.doc_id is None and x.n_chars == len("again\nand again")]
    assert len(same) == 60 and sum(x.near_next == 1 for x in same) >= 59


def test_one_repeated_row(spark, monkeypatch):
    monkeypatch.setattr(fp, "HOT", 2)
    got = fp.edited_fingerprints(spark.createDataFrame([(4, "all the same")] * 9, "doc_id long, text string")).collect()
    assert len(got) == 9 and {(x.doc_id, x.near_next, x.fingerprint) for x in got} == {(4, 1.0, got[0].fingerprint)}


def vectors(spark, texts):
    got = fp.sums(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), ["k"], "t").collect()
    return [tuple(x[c] for c in fp.SUMS) for x in sorted(got, key=lambda x: x.k)]


def test_homomorphic(spark):
    a, b, ab, ba, c = vectors(spark, ["one line\n", "two\nthree x y z", "one line\n\ntwo\nthree x y z", "three x y z\ntwo\n\none line", "one line\n\ntwo\nthree x y"])
    assert ab == ba == tuple(x + y for x, y in zip(a, b, strict=True)) and c != ab


@pytest.mark.parametrize("keys", [[], [5], [0, 1, 2], [-9, 3, 4095, 4096, 1 << 20, (1 << 36) + 7, 1 << 62], list(range(0, 30000, 7))])
def test_following(spark, keys):
    got = {x.key: x.next for x in fp.following(spark.createDataFrame([(k,) for k in keys], "key long")).collect()}
    assert got == dict(zip(keys, [*keys[1:], None][:len(keys)], strict=True))


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(3, "only words here")], "doc_id long, text string")
    x, = fp.edited_fingerprints(docs).collect()
    assert x.near_next == 1 and x.n_chars == 15
    assert fp.edited_fingerprints(docs.limit(0)).collect() == []


def test_native(spark):
    docs = spark.createDataFrame([(3, "only words here")], "doc_id long, text string")
    assert "Python" not in fp.edited_fingerprints(docs)._jdf.queryExecution().toString()


def test_texts_are_shuffled_once(spark):
    """The rows' own path has one exchange: texts by bucket; sums and comparisons follow in place."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(600)], "doc_id long, text string")
    plan = fp.edited_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    inside = plan[plan.index("Union"):].split("\n   :- ", 1)[1].split("\n   +- ", 1)[0]
    assert inside.count("Exchange") == 1 and "HashAggregate" in inside
