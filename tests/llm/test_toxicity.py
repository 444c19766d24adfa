"""Toxicity: automata against plain edit distances, quotation, term choice, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from tripmart.llm import toxicity as tx


def distance(a, b):
    """Edits with swaps of neighbours, by the full table."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def slow_match(word, terms):
    best = None
    for i, (term, stem) in enumerate(terms):
        e = min(distance(word[:n], term) for n in range(len(word) + 1)) if stem else distance(word, term)
        if e <= tx.edits_allowed(term, stem) and (best is None or (e, i) < best):
            best = (e, i)
    return best


def test_matcher():
    r = random.Random(6)
    terms = [("abcde", False), ("abba", False), ("cabbage", True), ("bcadeabcd", False), ("abc", True), ("dddddddd", True), ("edcba", False)]
    m = tx.Matcher(terms)
    for _ in range(6000):
        word = list(r.choice(terms)[0])
        for _ in range(r.randint(0, 4)):
            at = r.randrange(len(word) + 1)
            kind = r.randrange(4)
            if kind == 0:
                word.insert(at, r.choice("abcdex"))
            elif kind == 1 and word:
                word.pop(at - 1)
            elif kind == 2 and word:
                word[at - 1] = r.choice("abcdex")
            elif at + 1 < len(word):
                word[at], word[at + 1] = word[at + 1], word[at]
        word = "".join(word)
        assert m.match(word) == slow_match(word, terms), word
    assert tx.Matcher([]).match("any") is None and m.match("") is None


def test_quotation_scores_lower():
    model = tx.Model([("moron", False)], [-3.0, 4.0, 4.0, -0.5, 0.0, 0.5, 0.0])
    m = tx.Matcher(model.terms)
    score = lambda t: model.score(tx.features(t, m))
    plain, quote, wrong = score("you are a moron and nothing else"), score('he said "a moron and nothing else" then'), score("you are a mroon and nothing else")
    assert plain > quote > score("nothing to see here") and wrong > score("nothing")
    assert tx.quoted('a "b c', 4) and not tx.quoted('a "b" c', 6) and not tx.quoted('"a\nb', 3) and tx.quoted("x „y z", 5) and not tx.quoted("x „y“ z", 6)


def corpus(n, r):
    """Texts of invented words; toxic ones hold at least two insults, in one language words of a stem."""
    rows = []
    for i in range(n):
        words = ["".join(r.choice(["ba", "do", "ke", "li", "nu", "ra"]) for _ in range(r.randint(2, 5))) for _ in range(r.randint(20, 80))]
        toxic = r.random() < 0.25
        for _ in range(r.randint(2, 5) * toxic):
            words.insert(r.randrange(len(words)), r.choice(["scumbag", "fathead", "zwolf" + r.choice(["ba", "do", "ke", "li", "nu"]) + r.choice(["ra", "xi", "vo"])]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_misspelling(spark):
    rows = corpus(900, random.Random(1))
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t, _ in rows] + [(None, None, "x", 0), (0, rows[0][1], "x", 0), (5000, "", "y", 0)], "doc_id long, text string, lang string, score int")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = tx.train(docs, labels)
    assert {"scumbag", "fathead"} < {t for t, _ in model.terms} and any(stem and "zwolf".startswith(t[:5]) for t, stem in model.terms)
    got = tx.score_toxicity(docs, model).select("doc_id", "score", "predicted", tx.held_out("doc_id").alias("h")).collect()
    assert len(got) == len(rows) + 3 and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)
    truth = {i: y for i, _, y in rows}
    out = [x for x in got if x.h and x.doc_id in truth]
    assert {x.doc_id for x in out} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(x.predicted == truth[x.doc_id] for x in out) >= 0.98 * len(out)
    kept = tx.without_toxic(docs, model)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {x.doc_id for x in got if not x.predicted}
    fresh = spark.createDataFrame([(1, "ba do scumbga nula scubmag kera"), (2, "ba do nula kera")], "doc_id long, text string")
    a, b = sorted(tx.score_toxicity(fresh, model).collect())
    assert a.score >= b.score


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    rows = corpus(300, random.Random(2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    flip = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows], "doc_id long, toxic int")
    a, b = tx.train(docs, docs.select("doc_id", "toxic")), tx.train(docs, flip)
    assert a.terms == b.terms and a.weights == pytest.approx(b.weights, abs=1e-5)


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1), (2, 1)]])
def test_too_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, None)], "doc_id long, text string")
    model = tx.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [x.predicted for x in tx.score_toxicity(docs, model).collect()] == [0, 0, 0]
    assert tx.score_toxicity(docs.limit(0), model).collect() == []


def test_copies_do_not_make_terms(spark):
    rows = [(i, "common words " * 5 + "oddword here", 1) for i in range(40)] + [(100 + i, f"plain text number {i}", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert tx.train(docs, docs.select("doc_id", "toxic")).terms == []


def test_fixed_wording_of_different_texts_makes_terms(spark):
    r = random.Random(8)
    rows = [(i, t + " you utter wazzock indeed " * y + t[::-1], y) for i, (_, t, _) in enumerate(corpus(400, r)) for y in [int(i % 5 == 0)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = tx.train(docs, docs.select("doc_id", "toxic"))
    assert {t for t in model.terms if t[0].startswith("wazz")}
    scored = tx.score_toxicity(docs, model).select("doc_id", "predicted").collect()
    assert sum(x.predicted == (x.doc_id % 5 == 0) for x in scored) >= 0.98 * len(rows)


def test_near_copies_do_not_make_terms(spark):
    r = random.Random(9)
    words = [t for _, t, _ in corpus(1, r)][0].split() + ["oddword"]
    rows = [(i, " ".join(words[:i % 20] + [f"n{i}"] + words[i % 20:]), 1) for i in range(60)] + [(100 + i, f"plain text number {i}", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert tx.train(docs, docs.select("doc_id", "toxic")).terms == []


def test_copies_by_signature():
    r = random.Random(10)
    texts = [" ".join(r.choice("abcdefghij") * r.randint(1, 4) for _ in range(60)) for _ in range(30)]
    near = [f"{t} and more" for t in texts[:10]]
    group = tx.copies({tx.text_id(t): tx.signature(t) for t in [*texts, *near, None, "", "one"]})
    assert len(set(group.values())) == 32 and all(group[tx.text_id(a)] == group[tx.text_id(b)] for a, b in zip(texts, near, strict=False))


def test_quotes_are_carried_along_the_line():
    import re
    r = random.Random(12)

    def plain(text, start):
        line = text[text.rfind("\n", 0, start) + 1:start]
        if line.count('"') % 2:
            return True
        last = max(line.rfind(c) for c in tx.OPENING)
        return last > max(line.rfind(c) for c in tx.CLOSING) or 0 <= last and line[last] in "„" and not re.search("[”“]", line[last + 1:])

    for _ in range(2000):
        text = "".join(r.choice('ab "“”„«»‹›\n') for _ in range(r.randrange(1, 40)))
        starts = sorted(r.sample(range(len(text)), r.randrange(0, len(text))))
        assert list(tx.all_quoted(text, starts)) == [bool(plain(text, s)) for s in starts], text


def test_many_terms_in_one_line_take_time_by_length():
    import time
    matcher = tx.Matcher([("dolt", False)])
    begin = time.perf_counter()
    got = tx.features('he said "dolt" dolt ' * 50_000, matcher)
    assert got[0] > 0 and time.perf_counter() - begin < 20


def test_weights_of_repeated_rows():
    x, y = np.random.default_rng(2).normal(size=(60, 3)), np.arange(60) % 2.0
    n = np.arange(60) % 4 + 1.0
    assert tx.fit(x, y, n) == pytest.approx(tx.fit(np.repeat(x, n.astype(int), 0), np.repeat(y, n.astype(int))), rel=1e-6)
