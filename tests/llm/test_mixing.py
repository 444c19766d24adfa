"""Poisson replication: draws against plain inversion, weights met, order by hash."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripmart.llm import mixing


def draw(seed, doc_id, rate):
    """Sum of inversions at means of at most PART."""
    parts, total = max(1, math.ceil(rate / mixing.PART)), 0
    for i in range(1, parts + 1):
        u = (int(hashlib.md5(f"{seed}|draw|{doc_id}|{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        mean = rate / parts
        k, p = 0, math.exp(-mean)
        c = p
        while c < u:
            k += 1
            p *= mean / k
            c += p
        total += k
    return total


def docs(spark, n):
    rows = [(i, f"text {i}", "en", "hot" if i % 3 else f"s{i % 7}", 6) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("weights,size", [(None, None), ({"hot": 1.0, "s1": 3.0, "none": 9.0}, 900), ({"s1": 1.0}, 40_000)])
def test_draws(spark, weights, size):
    rows, table = docs(spark, 600)
    n = Counter(r[3] for r in rows)
    w = {s: math.sqrt(k) if weights is None else weights.get(s, 0.0) for s, k in n.items()}
    total = sum(w.values())
    want = {i: draw(17, i, w[s] / total * (size or len(rows)) / n[s]) for i, _, _, s, _ in rows if w[s]}
    got = mixing.mix(table, weights=weights, size=size).collect()
    assert Counter(x.doc_id for x in got) == {i: k for i, k in want.items() if k}
    assert all(x.copies == want[x.doc_id] and 1 <= x.copy <= x.copies for x in got)
    assert all(x.shuffle_key == hashlib.md5(f"17|order|{x.doc_id}|{x.copy}".encode()).hexdigest() for x in got)
    assert len({(x.doc_id, x.copy) for x in got}) == len(got)
    assert abs(len(got) - sum(w[s] / total * (size or len(rows)) for s in n)) < 6 * math.sqrt(size or len(rows))


def test_shuffled_and_native(spark):
    _, table = docs(spark, 300)
    out = mixing.mix(table)
    keys = [[x.shuffle_key for x in p] for p in out.rdd.glom().collect()]
    assert all(k == sorted(k) for k in keys)
    assert "Python" not in out._jdf.queryExecution().toString()


def test_nulls_repeats_clashes_and_empty(spark):
    rows = [(None, "a", None, 1), (None, None, "x", 2), (1, "b", "x", 3), (1, "b", "x", 3)] * 5
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    got = mixing.mix(table, size=100).collect()
    per = Counter((x.doc_id, x.text, x.source) for x in got)
    assert per[1, "b", "x"] == 10 * next(x.copies for x in got if x.doc_id == 1)
    assert mixing.mix(table, size=100).columns == ["doc_id", "text", "source", "copies", "copy", "shuffle_key"]
    assert mixing.mix(table.limit(0)).collect() == []
    assert mixing.mix(table.withColumn("source", F.lit("y")), weights={"x": 1.0}).collect() == []
    assert mixing.mix(table, weights={}).collect() == []
