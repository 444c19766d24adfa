"""Language-model scores: base by brute force, the model against plain loops and numerical gradients."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tripmart.llm import attention, lm
from tripmart.llm.attention import MEMBERS, STRIDE, WINDOW, Scorer, Weights
from tripmart.llm.token_counts import encoder


COUNTS = np.random.default_rng(9).integers(0, 1000, attention.CLASSES).astype(float)


def model(seed=3):
    r = np.random.default_rng(seed)
    w = Weights.initial(r.integers(1, 1000, attention.CLASSES).astype(float), seed)
    w.vector += r.normal(0, 0.1, len(w.vector)).astype(np.float32)
    return w


def slow_score(w, text, begin):
    """Each id once: from the first window, or from the last STRIDE places of the first later window that has it there."""
    ids, total = [begin, *text], 0.0
    for t in range(len(text)):
        s = 0
        while t >= s + WINDOW:
            s += STRIDE
        h = np.array([w.embed[ids[s + j]] + w.place[j] for j in range(t - s + 1)], float)
        q, k, v = h[-1] @ w.query, h @ w.key, h @ w.value
        a = np.exp(k @ q / math.sqrt(attention.WIDTH))
        r = h[-1] + (a / a.sum()) @ v @ w.out
        g, m = divmod(int(text[t]), MEMBERS)
        p = np.prod([np.exp(z[i]) / np.exp(z).sum() for z, i in ((r @ w.group + w.group_bias, g), (r @ w.member[g] + w.member_bias[g], m))])
        total += math.log((1 - attention.MIX) * p + attention.MIX * (COUNTS[text[t]] + 1) / (COUNTS + 1).sum())
    return total


def test_scores_once_from_overlapping_windows():
    r, w = np.random.default_rng(1), model()
    texts = [r.integers(0, attention.CLASSES, n).astype(np.int16) for n in (1, 2, 31, 32, 33, 55, 56, 57, 80, 81, 300, 1500)]
    assert Scorer(w, COUNTS).score(texts, 7) == pytest.approx([slow_score(w, t, 7) for t in texts], rel=1e-4)
    assert len(Scorer(w, COUNTS).score([], 7)) == 0


def test_probabilities_add_up():
    w = model()
    r = Scorer(w, COUNTS).attend(np.arange(WINDOW, dtype=np.int16)[None])[-1:]
    every = np.arange(attention.CLASSES)
    assert np.exp(Scorer(w, COUNTS).log_probability(np.repeat(r, len(every), 0), every)).sum() == pytest.approx(1, rel=1e-4)
    counts = np.random.default_rng(2).integers(0, 50, 5000)
    c = lm.Classes(counts)
    assert np.bincount(c.of, np.exp(c.log_share), attention.CLASSES) == pytest.approx(np.ones(attention.CLASSES))


def test_gradient():
    r = np.random.default_rng(4)
    w = Weights(model().vector.astype(np.float64))
    ids = r.integers(0, attention.CLASSES, (3, WINDOW + 1))
    ids[1, 9:] = -1
    loss, g = attention.loss_and_gradient(w, ids)
    own = Weights(g)
    names = list(attention.SHAPES)
    at = 0
    for name in names:
        size = int(np.prod(attention.SHAPES[name]))
        nonzero = np.flatnonzero(getattr(own, name).reshape(-1))
        for i in r.choice(nonzero, min(5, len(nonzero)), replace=False):
            moved = w.vector.copy()
            moved[at + i] += 1e-5
            up = attention.loss_and_gradient(Weights(moved), ids)[0]
            moved[at + i] -= 2e-5
            down = attention.loss_and_gradient(Weights(moved), ids)[0]
            assert (up - down) / 2e-5 == pytest.approx(g[at + i], rel=1e-2, abs=1e-6), name
        at += size


def test_training_learns():
    r = np.random.default_rng(5)
    ids = (np.arange(WINDOW + 1) + r.integers(0, 20, (400, 1))) % 20  # each id fixes the next
    w = Weights.initial(np.bincount(ids.reshape(-1), minlength=attention.CLASSES).astype(float))
    before = attention.loss_and_gradient(w, ids)[0]
    after = attention.loss_and_gradient(attention.train(w, ids.astype(np.int16), epochs=12), ids)[0]
    assert after < 0.3 * before


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


@pytest.mark.parametrize("frequent", [200_000, 3, 0])
def test_base_score(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(["The", "the", "of", "Éa", "x"] + [f"w{r.randint(0, 400)}"]) for _ in range(r.randint(0, 60)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, " \x0b\n"), (None, "the odd one"), (3, rows[3][1]), (2 ** 60 + 1, "a\x1cb c d")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n int, word string")
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter()
    for (_, t), h in zip(rows, out, strict=True):
        if not h:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for (i, t), h in zip(rows, out, strict=True):
        tokens = [*words(t), None]
        want.append((i, h, len(tokens), sum(counts[x] > 0 for x in tokens), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens)))
    got = lm.scores(docs, rounds=1).collect()
    key = lambda x: (x[0] is None, x[0] or 0)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert [x[5] for x in got] == pytest.approx([x[5] for x in want])
    assert all(x[6] < 0 for x in got)


def test_average(spark):
    vectors = np.random.default_rng(1).normal(size=(70, 5))
    rows = [(bytearray((x * k).tobytes()), k) for k, x in enumerate(vectors)]
    mean = lm.average(spark.createDataFrame(rows, lm.SUM_FIELDS), 5)
    assert mean == pytest.approx((vectors * np.arange(70)[:, None]).sum(0) / np.arange(70).sum())
    assert lm.average(spark.createDataFrame([], lm.SUM_FIELDS), 5) is None


def test_empty_table(spark):
    assert lm.scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_model_beats_word_counts_on_patterns(spark):
    """Held-out texts of a regular language are likelier by the model than by word counts."""
    r = random.Random(3)
    rows = [(i, " ".join(f"{chr(97 + (k + s) % 23) * 2}{chr(97 + (k * k + s) % 26)}" for k in range(r.randint(20, 60)))) for i in range(1500) for s in [r.randint(0, 1000)]]
    got = lm.scores(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert sum(x.score for x in got) > sum(x.base_score for x in got)


def test_subwords_are_those_of_single_words():
    subwords = lm.Subwords(lm.VOCABULARY, {b"the": 5})
    r = random.Random(7)
    pieces = ["the", "of", "x1", "\xa0", "a\xa0", "\x85b", "\u3000", "é!", "1,2", "'s", "\x00", "-", "漢字"]
    for _ in range(200):
        w = [("".join(r.choice(pieces) for _ in range(r.randint(1, 3)))).encode() for _ in range(r.randint(0, 8))]
        w = [x for y in w for x in y.lower().split()]
        ids = subwords.tokens(subwords.places(w)).tolist()
        assert ids == [i for x in w for i in encoder(lm.VOCABULARY)[0].encode_ordinary(" " + x.decode())] + [subwords.size - 1]
        assert subwords.known_counts(subwords.places(w)).tolist() == [5 if x == b"the" else -1 for x in w]


def test_all_windows_cover_every_token():
    subwords = lm.Subwords(lm.VOCABULARY)
    classes = lm.Classes(np.arange(subwords.size))
    texts = [None, "", "one", "many Words " * 500, "x" * 9000, " ".join(f"n{i}" for i in range(3000)), "a " * (WINDOW - 1), "a " * WINDOW]
    (rows, counts), at = lm.all_windows(texts, subwords, classes), 0
    assert counts.tolist() == [max(1, -(-(sum(len(encoder(lm.VOCABULARY)[0].encode_ordinary(" " + w)) for w in words(t)) + 1) // WINDOW)) for t in texts]
    for t in texts:
        want = classes.of[[i for w in words(t) for i in encoder(lm.VOCABULARY)[0].encode_ordinary(" " + w)] + [subwords.size - 1]].tolist()
        own = rows[at:at + -(-len(want) // WINDOW)]
        at += len(own)
        targets = own[:, 1:].reshape(-1)
        assert targets[targets >= 0].tolist() == want == targets[:len(want)].tolist()
        assert own[:, 0].tolist() == [classes.end, *own[:-1, -1].tolist()]
    assert at == len(rows) and len(lm.all_windows([], subwords, classes)[0]) == 0


def learned_from(spark, texts):
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, h long")
    return frame, lm.Classes(lm.subword_counts(lm.word_counts(frame), lm.VOCABULARY))


@pytest.mark.parametrize("per_shard", [262_144, 8])
def test_every_token_is_trained_on_once(spark, monkeypatch, per_shard):
    """The windows that shards go through in all rounds hold as many targets as the texts have tokens and ends."""
    monkeypatch.setattr(lm, "WINDOWS_PER_SHARD", per_shard)
    texts = ["word " * 4000, "other words here " * 700, None, "short", "short"]
    frame, classes = learned_from(spark, texts)
    seen = []
    monkeypatch.setattr(lm, "average", lambda sums, size: seen.append(sum(r["n"] for r in sums.collect())))
    lm.fit(frame, classes, lm.VOCABULARY)
    assert len(seen) == lm.ROUNDS and sum(seen) == sum(-(-(len(words(t)) + 1) // WINDOW) for t in texts)


def test_weights_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "WINDOWS_PER_SHARD", 256)
    r = random.Random(8)
    texts = [" ".join(r.choice(["the", "of", f"w{r.randint(0, 99)}"]) for _ in range(r.randint(1, 300))) for _ in range(200)]
    frame, classes = learned_from(spark, texts)
    one, many = (lm.fit(frame.repartition(n), classes, lm.VOCABULARY, rounds=3).vector for n in (1, 7))
    assert np.abs(one - many).max() < 1e-5 and np.abs(one - Weights.initial(classes.counts).vector).max() > 0.05


def test_word_shares():
    """Each word is spelled, or drawn by its count if it is frequent; probabilities add up over both ways."""
    spelled = np.log([0.5, 0.25, 0.1, 0.2])
    shares = [np.log([1.0, 0.5, 1.0]), np.log([0.25])]
    got = lm.word_scores(spelled, shares, [np.array([2, 1]), np.array([1])], [np.array([3, -1]), np.array([10])], 0.75, 20)
    spelt = (0.0625 * 0.1, 0.05)
    mixed = ((0.25 * 0.0625 + 0.75 * 3 / 20) * (0.25 * 0.1), 0.25 * 0.05 + 0.75 * 10 / 20)
    assert got == pytest.approx([math.log((a + b) / 2) for a, b in zip(spelt, mixed, strict=True)])
    assert lm.word_scores(spelled, shares, [np.array([2, 1]), np.array([1])], [np.array([3, -1]), np.array([10])], 0.0, 20) == pytest.approx([math.log(x) for x in spelt])
    assert len(lm.word_scores(np.zeros(0), [], [], [], 0.5, 1)) == 0


def test_texts_learned_from_are_likelier_than_by_word_counts(spark):
    """On the documents, whose words are seen in training; in 2 and in 8 partitions alike."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [{(x.doc_id, x.score) for x in lm.scores(docs.repartition(n)).where("not held_out").collect()} for n in (2, 8)]
    assert {i for i, _ in got[0]} == {i for i, _ in got[1]}
    a, b = (np.array([x for _, x in sorted(g)]) for g in got)
    assert np.abs(a - b).max() < 1e-3
    base = lm.scores(docs, rounds=1).where("not held_out").selectExpr("sum(base_score)").first()[0]
    assert a.sum() > base


def test_later_windows_attend_from_fresh_places_alone(monkeypatch):
    """What a window before has scored is context: a text's every id is attended from once."""
    attend, rows = Scorer.attend, []

    def counted(self, *args):
        rows.append(attend(self, *args))
        return rows[-1]

    monkeypatch.setattr(Scorer, "attend", counted)
    texts = [np.arange(n, dtype=np.int16) % 50 for n in (WINDOW, WINDOW + STRIDE, WINDOW + 40 * STRIDE)]
    Scorer(model(), COUNTS).positions(texts, 7)
    assert sum(map(len, rows)) == sum(map(len, texts))


def test_gradient_of_logits_at_the_bound():
    """Logits beyond the bound pass no gradient on."""
    r = np.random.default_rng(6)
    w = Weights(model().vector.astype(np.float64))
    w.query[:] *= 60
    ids = r.integers(0, attention.CLASSES, (4, WINDOW + 1))
    _, (*_, inside, _, _) = attention.attend(w, ids[:, :-1])
    assert inside is not None and 0 < inside.mean() < 1
    g = Weights(attention.loss_and_gradient(w, ids)[1])
    for i, j in ((0, 0), (3, 5), (15, 2)):
        w.key[i, j] += 1e-6
        up = attention.loss_and_gradient(w, ids)[0]
        w.key[i, j] -= 2e-6
        down = attention.loss_and_gradient(w, ids)[0]
        w.key[i, j] += 1e-6
        assert (up - down) / 2e-6 == pytest.approx(g.key[i, j], rel=2e-2, abs=1e-6)


def test_chunks_spell_texts_with_each_word_encoded_once():
    texts = [None, "", " \x0b\n", "The the of", "É a\x1cb \xa0 c", "many Words " * 50, "the"]
    chunk, found = lm.told_apart(pa.array(texts, pa.string()), lm.VOCABULARY)
    each = [words(t) for t in texts]
    assert sorted(found.to_pylist()) == sorted({w for t in each for w in t})
    assert chunk.lengths.tolist() == [len(t) for t in each]
    assert [found[i].as_py() for i in chunk.places] == [w for t in each for w in t]
    encode = encoder(lm.VOCABULARY)[0].encode_ordinary
    want = [[i for w in t for i in encode(" " + w)] + [-7] for t in each]
    tokens, sizes, places, of_word = chunk.spelled(-7)
    assert tokens.tolist() == [i for t in want for i in t] and sizes.tolist() == [len(t) for t in want]
    assert len(places) == len(of_word) == sum(map(len, each)) + len(each) and of_word.sum() == len(tokens)
    assert lm.told_apart(pa.array([], pa.string()), lm.VOCABULARY)[0].spelled(1)[0].tolist() == []


def test_pieces_cover_texts_in_order(monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 10)
    texts = pa.array(["x" * n if n >= 0 else None for n in (3, 40, -1, 0, 9, 9, 1, 25)], pa.string())
    got = list(lm.pieces(texts))
    assert [i for a, n in got for i in range(a, a + n)] == list(range(len(texts))) and len(got) > 3
    assert lm.split_at(pa.scalar("")).to_pylist() == [] and lm.split_at(pa.scalar("a b")).to_pylist() == ["a", "b"]
    for x in ([], [0, 255], [70_000, 1]):
        assert lm.unpacked(lm.packed(np.array(x, np.int64))[0]).tolist() == x


def test_gradient_adds_up_over_parts(monkeypatch):
    w, ids = Weights(model().vector.astype(np.float64)), np.random.default_rng(3).integers(0, attention.CLASSES, (10, WINDOW + 1))
    ids[4, 5:] = -1
    loss, whole = attention.loss_and_gradient(w, ids)
    monkeypatch.setattr(attention, "PART", 3)
    parts = attention.loss_and_gradient(w, ids)
    assert parts[0] == pytest.approx(loss) and np.abs(parts[1] - whole).max() < 1e-12
    assert np.array_equal(attention.loss_and_gradient(w, ids, wanted=False)[1], parts[1])
