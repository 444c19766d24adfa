"""The pipeline against a plain Python version of its stages, on a whole small table."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import decontaminate, secrets, simhash, toxicity

SF = "/root/testdata/sf0.001"


def distinct_shingles(text):
    w = decontaminate.words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def contains(doc, item):
    w, need = decontaminate.words(doc), distinct_shingles(item)
    k = len(next(iter(need), ()))
    have = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return bool(need) and len(need & have) >= 0.8 * len(need) - 1e-9


def draw(seed, doc_id, rate):
    u = (int(hashlib.md5(f"{seed}|draw|{doc_id}|1".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
    k, p = 0, math.exp(-rate)
    c = p
    while c < u:
        k += 1
        p *= rate / k
        c += p
    return k


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "source_mixing"]


def test_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    matcher = toxicity.Matcher(model.terms)
    rows = [r for r in rows if model.score(toxicity.features(r.text, matcher)) < 0.5]

    prints = {r.doc_id: simhash.fingerprint(r.text) for r in rows}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = [r for r in rows if find(r.doc_id) == r.doc_id]

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(contains(r.text, t) for t in items)]
    n = Counter(r.source for r in rows)
    weight = sum(math.sqrt(x) for x in n.values())
    want = Counter()
    for r in rows:
        k = draw(17, r.doc_id, math.sqrt(n[r.source]) / weight * len(rows) / n[r.source])
        for copy in range(1, k + 1):
            text = secrets.masked(r.text, secrets.scan(r.text))
            want[r.doc_id, text, r.lang, r.source, len(text), k, copy, hashlib.md5(f"17|order|{r.doc_id}|{copy}".encode()).hexdigest()] += 1

    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*docs.columns, "copies", "copy", "shuffle_key"]
    assert Counter(map(tuple, got.collect())) == want
    assert 0 < len(rows) < docs.count()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_nulls_repeats_and_empty_tables(spark, name, stage):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "words only here", "en", None, 15), (3, None, "en", "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = docs.withColumns({"score": F.lit("x"), "copies": F.lit(1), "fp": F.lit(2), "item_id": F.lit(3)})
    for table in (docs, docs.limit(0), clash):
        out = stage(spark, table, SF)
        kept = out.collect()
        assert set(table.columns) <= set(out.columns) and len(kept) <= 20
        if name != "source_mixing":
            assert out.columns == table.columns
        if name in ("toxicity", "benchmark_decontamination", "secret_scans"):
            assert len(kept) == table.count()
        if name == "simhash_near_dedup" and table is not docs.limit(0):
            assert sorted(x.doc_id for x in kept if x.doc_id is not None) == ([1, 2] if table.count() else [])
