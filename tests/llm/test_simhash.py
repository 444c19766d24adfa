"""SimHash groups against brute force."""

import random
import re

import pytest
import xxhash

from tripmart.llm import simhash
from tripmart.llm.graph import components


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(values, near):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[:i]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", ["", None, " \n", "One", "Two words", "a B c", "É x É y\x0bz\x1cq   w", "a b c a b c a b", "x" * 5000 + " y" * 300])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(str(i % 97) for i in range(1000))
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("max_bits,limit", [(2, 256), (2, 3), (1, 2), (3, 4), (0, 9)])
def test_links_find_all_components(spark, max_bits, limit):
    r = random.Random(5)
    values = set()
    for _ in range(12):
        x = r.getrandbits(64)
        for _ in range(12):
            values.add(signed(x))
            for b in r.sample(range(64), r.randint(0, 4)):
                x ^= 1 << b
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"), max_bits, group_limit=limit)
    rows = links.collect()
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= max_bits for a, b in rows)
    got = {v: v for v in values} | {x.node: x.root for x in components(links).collect()}
    assert got == groups(values, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= max_bits)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def test_near_duplicates(spark):
    r = random.Random(1)
    base = [" ".join(r.choice(["ab", "cd", "ef", "gh", "ij", "kl"]) + str(r.randint(0, 50)) for _ in range(300)) for _ in range(8)]
    texts = ["", None, "  ", "word", *base, *(b + " tail" for b in base), *base[:3]]
    rows = [(i * 3 % 101, t, "x", i) for i, t in enumerate(texts)] + [(None, "word", "x", 0), (None, "alone here now", "x", 1), (0, "", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = [(x.doc_id, x.fp, x.component_id) for x in simhash.near_duplicates(docs).collect()]
    prints = [signed(slow_fingerprint(t)) for _, t, _, _ in rows]
    root = groups(set(prints), lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 2)
    first = {}
    for (i, *_), p in zip(rows, prints, strict=True):
        if i is not None:
            first[root[p]] = min(i, first.get(root[p], i))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted([(i, p, first.get(root[p])) for (i, *_), p in zip(rows, prints, strict=True)], key=key)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == sorted(first.values())
    assert [x.text for x in kept.collect() if x.doc_id is None] == ["alone here now"]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
