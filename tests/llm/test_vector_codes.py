"""Vector codes against a plain version that looks at every entry."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from tripmart.llm import vector_codes

DDL = "vec_id long, embedding array<double>, label int"


def usable(v, parts, dimension):
    return v is not None and len(v) == dimension and len(v) % parts == 0 and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, parts, entries, rounds):
    """{(vec_id, vector): (code, error, label_error)}, digest."""
    first = min((r for r in rows if r[1] and usable(r[1], parts, len(r[1]))), key=lambda r: (r[0] is None, r[0], r[1]))
    kept = sorted((r for r in rows if usable(r[1], parts, len(first[1]))), key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(first[1]) // parts
    cut = [[[math.floor(Fraction(c) * 256) for c in r[1][p * width:(p + 1) * width]] for p in range(parts)] for r in kept]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        fresh = []
        for p, book in enumerate(books):
            own = [nearest(v[p], book)[1] for v in cut]
            fresh.append([[sum(c) // len(c) for c in zip(*(v[p] for v, o in zip(cut, own) if o == i))] if i in own else e for i, e in enumerate(book)])
        books = fresh
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    labels = {}
    for r, e in zip(kept, errors):
        labels[r[2]] = labels.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((r[0] if r[0] is not None else -1, "".join(f"{i:02x}" for _, i in f), e, labels[r[2]], digest) for r, f, e in zip(kept, found, errors))


def result(spark, rows, parts, entries, rounds):
    df = spark.createDataFrame(rows, DDL).repartition(3)
    out = vector_codes.compress(df, parts, entries, rounds).collect()
    return sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in out)


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_looking_at_every_entry(spark, seed):
    r = np.random.default_rng(seed)
    # Few different components, so that sums, distances and whole vectors tie.
    rows = [(int(i), [float(c) for c in r.integers(-2, 3, 8) / (2 if seed == 1 else 100)], int(r.integers(0, 3)) if i % 7 else None) for i in range(150)]
    assert result(spark, rows, 4, 12, 2) == brute(rows, 4, 12, 2)


def test_rows_left_out_repeats_nulls_and_large_components(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.5, -0.25, 1.0, 2.0]
    rows = [(5, good, 1), (5, good, 1), (1, None, 1), (2, [0.1, None, 0.2, 0.3], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [0.0, -inf, 0.0, 0.0], 1),
            (6, [], 1), (7, [1.0, 2.0, 3.0], 1), (8, [1.0] * 6, 1), (None, [0.0, 0.0, -0.001, 0.0], None), (9, [0.0, 4.0, -7.5, 0.0], None), (10, [1e5, -1e6, 1e7, 3.0], 2)]
    assert result(spark, rows, 2, 3, 2) == brute(rows, 2, 3, 2)
    huge = [*rows[:1], (11, [1e30, 0.0, 0.0, 0.0], 1), (12, [1e300, 0.0, -1e300, 0.0], 1)]
    out = result(spark, huge, 2, 2, 1)
    assert len(out) == 3 and out[0][1] == "0000"
    assert result(spark, [(1, None, 1)], 2, 3, 2) == [] == result(spark, [], 2, 3, 2)


def test_clashing_columns_are_not_read_and_codes_decode(spark):
    rows = [(i, [i / 8, -i / 16, i / 4, 1.0], i % 2, "x", 0) for i in range(40)]
    df = spark.createDataFrame(rows, DDL + ", code string, vector int")
    books = vector_codes.train(df, 2, 64, 0)
    coded = vector_codes.encode(df, books)
    assert coded.columns == ["vec_id", "label", "code", "error"]
    # As many entries as vectors: what comes back is the vector, floored to steps of 1/256.
    for r in vector_codes.decode(coded, books).collect():
        assert r["error"] == 0 and r["vector"] == rows[r["vec_id"]][1]


def test_search_skips_entries(spark):
    """The gap of sums ends the search before all entries are looked at."""
    r = np.random.default_rng(3)
    points = np.floor(r.normal(0, 100, (64, 4)))
    books = vector_codes.Codebooks((tuple(tuple(int(c) for c in p) for p in points),))
    search = vector_codes.Search(books)
    x = np.floor(r.normal(0, 100, (500, 4)))
    index, distance = search(x)
    full = ((x[:, None] - points) ** 2).sum(2)
    assert (index[:, 0] == full.argmin(1)).all() and (distance[:, 0] == full.min(1)).all()
    assert [search.one([int(c) for c in v], 0) for v in x[:50]] == list(zip(full.argmin(1)[:50], full.min(1)[:50]))
    assert ((points.sum(1) - x.sum(1)[:, None]) ** 2 > 4 * full.min(1)[:, None]).mean() > 0.3


def test_whole_table(spark):
    from tripmart.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = QUERIES["op12_vector_codes"](spark, sf)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, 16, 64, 2)
