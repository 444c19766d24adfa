"""Token attribution against character-by-character counting and an exact round trip."""

import random

import numpy as np
import pytest

from tripmart.llm import token_counts as tc


@pytest.mark.parametrize("text", ["", "plain words here.\n\nnext  line\n", "é ñ 漢字 🙂🙂 naïve\n🙂", "\n\n\n", " lead", "a" * 3000])
def test_spans_cover_the_text(text):
    start, end = tc.token_spans(text)
    encoding, sizes = tc.encoder(tc.VOCABULARY)
    ids = encoding.encode_ordinary(text)
    assert encoding.decode(ids) == text and len(ids) == len(start)
    assert set(i for s, e in zip(start, end, strict=True) for i in range(s, e)) == set(range(len(text)))
    assert all(np.diff(start) >= 0)


def slow(start, end, begins, ends, rule):
    n = len(begins)
    out = [0.0] * (n + 1)
    for s, e in zip(start, end, strict=True):
        chars = [next((i for i in reversed(range(n)) if begins[i] <= c), n) for c in range(s, e)]
        chars = [i if i < n and c < ends[i] else n for i, c in zip(chars, range(s, e), strict=True)]
        if rule == "start":
            out[chars[0]] += 1
        elif rule == "majority":
            out[min(set(chars), key=lambda i: (-chars.count(i), i))] += 1
        else:
            for i in chars:
                out[i] += 1 / (e - s)
    return out


@pytest.mark.parametrize("rule", tc.RULES)
def test_allocation(rule):
    r = random.Random(2)
    for _ in range(400):
        cuts = sorted(r.sample(range(41), r.randint(0, 8)))
        end = np.array(cuts[1:], np.int64)
        start = np.array(cuts[:-1], np.int64)[: len(end)]
        begins = np.array(sorted(r.sample(range(40), r.randint(0, 5))), np.int64)
        ends = begins + np.array([r.randint(0, 9) for _ in begins], np.int64)
        got = tc.allocate(start, end, begins, ends, rule)
        assert got == pytest.approx(slow(start, end, begins, ends, rule))
        assert got.sum() == pytest.approx(len(end))


def test_sections(spark):
    rows = [(1, "one two\n\nthree é\n", 0), (None, None, 1), (2, "", 2), (1, "one two\n\nthree é\n", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, section int")
    for rule in tc.RULES:
        got = tc.section_tokens(docs, rule).collect()
        assert sorted((x.doc_id or 0, x.section, x.begin, x.end) for x in got) == sorted([(0, 0, 0, 0), (2, 0, 0, 0)] + 2 * [(1, 0, 0, 8), (1, 1, 8, 9), (1, 2, 9, 17)])
        assert sum(x.n_tokens for x in got) == 2 * len(tc.token_spans(rows[0][1])[0])
        assert all(x.doc_tokens == len(tc.token_spans(rows[0][1])[0]) for x in got if x.doc_id == 1)
    assert tc.section_tokens(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        tc.section_tokens(docs, "none")


def test_fields(spark):
    docs = spark.createDataFrame([(5, "A \"title\"", "some body\ntext é", None)], "doc_id long, title string, body string, note string")
    x = tc.field_tokens(docs, ["title", "body", "note"]).first()
    whole = "A \"title\"\nsome body\ntext é\n"
    assert x.doc_tokens == len(tc.token_spans(whole)[0]) == x.n_title + x.n_body + x.n_note + x.n_rest
    assert x.n_title == len(tc.token_spans('A "title"')[0]) and x.n_note == 0 and x.n_rest >= 1
