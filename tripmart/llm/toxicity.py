"""Toxicity scores: Levenshtein automata intersected with a trie of learned terms, and scores of the context."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.graph import cut_lineage
from tripmart.llm.text import per_text

#: Labelled rows that the terms and the weights are learned from: about so many at most, by a hash of the id.
MAX_TRAINING = 20_000
#: A term must occur in this share of the toxic training texts, and in MIN_TOXIC of them: few terms can.
MIN_SHARE, MIN_TOXIC = 0.005, 4
#: How much likelier a term must be in toxic texts, and the least G statistic of its counts.
MIN_RATIO, MIN_G = 12.0, 20.0
#: Lengths of the stems (word beginnings) that may be terms.
STEMS = range(4, 9)
#: Texts are copies if so much of their signatures agrees, of BANDS times BAND minima; only texts that share a whole band are compared.
NEAR, BANDS, BAND = 0.5, 21, 3
FACTORS, TERMS = np.random.default_rng(7).integers(0, 1 << 63, (2, BANDS * BAND), np.uint64) * np.uint64(2) + np.uint64(1)
#: Words kept with their matches in a task.
CACHE = 400_000

WORD = re.compile(r"\w+")
OPENING, CLOSING = "“«„‹", "”»“›"
# Words near a term that report it, and words that address somebody.
REPORTING = frozenset("said says wrote writes called calls quote quoted word term dijo escribió palabra sagte schrieb wort dit écrit mot".split())
ADDRESSING = frozenset("you your you're du dich dir ihr tu te usted eres vous toi es".split())
WINDOW = 6


def edits_allowed(term: str, stem: bool) -> int:
    """Edits at which a word still counts as a term misspelled: none for short terms, 1 or 2 for longer ones."""
    n = len(term) - 2 * stem
    return 0 if n < 5 else 1 if n < 8 else 2


class Matcher:
    """The union of the Levenshtein automata of all terms, walked along their trie.

    A state is a set of (trie node, edits so far): reading a character takes
    a trie edge, substitutes, inserts or swaps two neighbours at one edit each, and
    deletions are followed at once.  Sets are made deterministic as they are met,
    so a word costs one look-up a character.  A stem matches any word that
    begins with it.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int, bool]]] = [[]]  # (term, allowed, stem)
        self.allowed = [0]  # most edits of any term below
        for i, (term, stem) in enumerate(terms):
            k, node = edits_allowed(term, stem), 0
            self.allowed[0] = max(self.allowed[0], k)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.allowed.append(0)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], k)
            self.ends[node].append((i, k, stem))
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.stems: list[tuple[int, int] | None] = []
        self.steps: list[dict[str, int]] = []
        self.finals: list[tuple[int, int] | None] = []
        self.start = self._number({(0, 0, "")}, None)
        self.found: dict[str, tuple[int, int] | None] = {}

    def _number(self, states: set[tuple[int, int, str]], stem: tuple[int, int] | None) -> int:
        """The number of a set of states after deletions; stem: the best (edits, term) of a stem already passed."""
        todo, closed = list(states), set(states)
        while todo:
            node, e, swap = todo.pop()
            if not swap:
                for child in self.children[node].values():
                    x = (child, e + 1, "")
                    if e < self.allowed[child] and x not in closed:
                        closed.add(x)
                        todo.append(x)
        best = stem
        for node, e, swap in closed:
            for term, k, is_stem in () if swap else self.ends[node]:
                if is_stem and e <= k and (best is None or (e, term) < best):
                    best = (e, term)
        key = frozenset(closed) | {("stem", best)}
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(frozenset(closed))
            self.steps.append({})
            final = best
            for node, e, swap in closed:
                for term, k, is_stem in () if swap else self.ends[node]:
                    if not is_stem and e <= k and (final is None or (e, term) < final):
                        final = (e, term)
            self.finals.append(final)
            self.stems.append(best)
        return self.numbers[key]

    def _step(self, number: int, c: str) -> int:
        after: set[tuple[int, int, str]] = set()
        for node, e, swap in self.sets[number]:
            if swap:
                if c == swap:
                    after.add((node, e, ""))
                continue
            for edge, child in self.children[node].items():
                if edge == c:
                    after.add((child, e, ""))
                elif e < self.allowed[child]:
                    after.add((child, e + 1, ""))
                below = self.children[child].get(c)
                if below is not None and edge != c and e < self.allowed[below]:
                    after.add((below, e + 1, edge))
            if e < self.allowed[node]:
                after.add((node, e + 1, ""))
        self.steps[number][c] = to = self._number(after, self.stems[number])
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the nearest term that the word is, misspelled or not; None if there is none."""
        if word in self.found:
            return self.found[word]
        state, steps = self.start, self.steps
        for c in word:
            to = steps[state].get(c)
            state = self._step(state, c) if to is None else to
            if not self.sets[state]:
                break
        if len(self.found) >= CACHE:
            self.found.clear()
        self.found[word] = self.finals[state]
        return self.found[word]


def all_quoted(text: str, starts: Iterable[int]) -> Iterator[bool]:
    """Whether each place, in ascending order, lies in quotation marks opened in its line.

    The state of the line is carried from place to place, so every
    character is looked at once.
    """
    at, odd, opened, closed, german, ended = 0, False, -1, -1, False, -1
    for start in starts:
        line = text.rfind("\n", at, start) + 1
        if line:
            at, odd, opened, closed, german, ended = line, False, -1, -1, False, -1
        odd ^= text.count('"', at, start) % 2 == 1
        last = max(text.rfind(c, at, start) for c in OPENING)
        if last >= 0:
            opened, german = last, text[last] == "„"
        closed = max(closed, *(text.rfind(c, at, start) for c in CLOSING))
        ended = max(ended, text.rfind("”", at, start), text.rfind("“", at, start))
        yield odd or opened > closed or opened >= 0 and german and ended < opened
        at = start


def quoted(text: str, start: int) -> bool:
    """Whether a place lies in quotation marks opened in its line."""
    return next(all_quoted(text, [start]))


def context(words: list[str], at: int, in_quotes: bool) -> float:
    """Score of a term's context: 1 for abuse in its own voice, less for a term that is quoted or reported."""
    near = set(words[max(0, at - WINDOW):at] + words[at + 1:at + 1 + WINDOW])
    score = 1.0 - 0.6 * in_quotes - 0.25 * bool(near & REPORTING) + 0.15 * bool(near & ADDRESSING)
    return min(1.0, max(0.1, score))


FEATURES = ("exact", "misspelled", "quoted", "distinct", "density", "any")


def features(text: str | None, matcher: Matcher) -> list[float]:
    """FEATURES of a whole text; zeros if no term occurs."""
    low = (text or "").lower()
    words = WORD.findall(low)
    match, found = matcher.match, matcher.found
    hits = [(i, m) for i, w in enumerate(words) if (m := found[w] if w in found else match(w))]
    if not hits:
        return [0.0] * len(FEATURES)
    wanted = {i for i, _ in hits}
    places = {i: m.start() for i, m in enumerate(WORD.finditer(low)) if i in wanted}
    exact = misspelled = in_quotes = 0.0
    for (i, (edits, _)), q in zip(hits, all_quoted(low, [places[i] for i, _ in hits]), strict=True):
        score = context(words, i, q)
        exact += score * (edits == 0)
        misspelled += score * (edits > 0)
        in_quotes += q
    terms = {term for _, (edits, term) in hits if edits == 0}
    return [math.log1p(exact), math.log1p(misspelled), math.log1p(in_quotes), math.log1p(len(terms)), math.log1p(100 * exact / len(words)), float(bool(terms))]


@dataclass
class Model:
    terms: list[tuple[str, bool]] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [0.0] * (len(FEATURES) + 1))

    def score(self, x: list[float]) -> float:
        z = self.weights[0] + sum(a * b for a, b in zip(self.weights[1:], x, strict=True))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, ridge: float = 0.1, steps: int = 60) -> list[float]:
    """Weights (first the constant) of a logistic regression by damped Newton steps; n: how often each row occurs."""
    n = np.ones(len(x)) if n is None else n
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(n @ np.logaddexp(0, np.where(y > 0, -z, z)) + v @ penalty @ v / 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (n * (p - y)) + penalty @ w)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w.tolist()


def terms_of(text: str | None) -> set[str]:
    """Distinct words of a text, and their stems marked by a star."""
    words = set(WORD.findall((text or "").lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def term_counts(texts: DataFrame, wanted: frozenset[str] | None = None) -> DataFrame:
    """(term, n): the number of texts that have each term (of those wanted), summed up in tasks first."""

    def start():
        def work(batch):
            n = Counter()
            for t in batch:
                n.update(terms_of(t) if wanted is None else terms_of(t) & wanted)
            return [0] * len(n), [list(n), list(n.values())]

        return work

    return per_text(texts, [], "text", "term string, n long", start).groupBy("term").agg(F.sum("n").alias("n"))


def signature(text: str | None) -> np.ndarray:
    """Minima of BANDS * BAND hashes over the runs of three words of a text."""
    words = WORD.findall((text or "").lower())
    runs = {" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))}
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs), np.uint64, len(runs))
    out = np.full(BANDS * BAND, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 4096):
        out = np.minimum(out, (hashes[at:at + 4096, None] * FACTORS + TERMS).min(0))
    return out


def copies(signatures: dict[int, np.ndarray]) -> dict[int, int]:
    """The group of each text: texts are of one group if they share NEAR of their signature, or are linked by others that do."""
    of = {h: h for h in signatures}

    def root(h: int) -> int:
        while of[h] != h:
            of[h] = h = of[of[h]]
        return h

    for at in range(0, BANDS * BAND, BAND):
        heads: dict[bytes, list[int]] = {}
        for h in sorted(signatures):
            own = signatures[h]
            near = heads.setdefault(own[at:at + BAND].tobytes(), [])
            head = next((x for x in near if np.count_nonzero(signatures[x] == own) >= NEAR * len(own)), None)
            if head is None:
                near.append(h)
            else:
                a, b = root(head), root(h)
                of[max(a, b)] = min(a, b)
    return {h: root(h) for h in of}


def text_id(text: str | None) -> int:
    return xxhash.xxh64_intdigest(text or "") >> 1


def different_counts(texts: DataFrame, wanted: frozenset[str]) -> DataFrame:
    """(term, n): the number of different texts that each of the wanted terms occurs in, where copies and near copies of one text count once.

    One signature a different text comes to the driver.
    """

    def sign():
        def work(batch):
            found = {text_id(t): t for t in batch}
            return [0] * len(found), [list(found), [signature(t).tobytes() for t in found.values()]]

        return work

    signed = per_text(texts, [], "text", "h long, signature binary", sign).groupBy("h").agg(F.first("signature").alias("signature"))
    group = copies({r["h"]: np.frombuffer(bytes(r["signature"]), np.uint64) for r in signed.collect()})

    def start():
        def work(batch):
            found = list({(x, group[text_id(t)]) for t in batch for x in terms_of(t) & wanted})
            return [0] * len(found), [[x for x, _ in found], [g for _, g in found]]

        return work

    return per_text(texts, [], "text", "term string, copies long", start).distinct().groupBy("term").agg(F.count("*").alias("n"))


def g_statistic(a: int, toxic: int, b: int, clean: int) -> float:
    """G of a term's a of toxic and b of clean texts against equal shares."""
    share = (a + b) / (toxic + clean)
    cells = ((a, toxic * share), (b, clean * share), (toxic - a, toxic * (1 - share)), (clean - b, clean * (1 - share)))
    return 2 * sum(n * math.log(n / e) for n, e in cells if n > 0 and e > 0)


def marking(in_toxic: dict[str, int], in_clean: dict[str, int], toxic: int, clean: int) -> dict[str, float]:
    """G of the terms that are much likelier in toxic texts."""
    g = {}
    for t, a in in_toxic.items():
        b = in_clean.get(t, 0)
        ratio = (a + 0.5) / (toxic + 1) / ((b + 0.5) / (clean + 1))
        if ratio >= MIN_RATIO and (score := g_statistic(a, toxic, b, clean)) >= MIN_G:
            g[t] = score
    return g


def choose_terms(g: dict[str, float], in_toxic: dict[str, int]) -> list[tuple[str, bool]]:
    """The terms to look for: whole words, and the stems of words that are not one word mostly.

    Of stems that begin one another the one of the largest G stays, the shorter of equals.
    """
    words = [t for t in g if not t.endswith("*")]
    one_word = {w[:n] + "*" for w in words for n in STEMS if in_toxic[w] >= 0.8 * in_toxic.get(w[:n] + "*", math.inf)}
    stems: list[str] = []
    for s in sorted((t for t in g if t.endswith("*") and t not in one_word), key=lambda t: (-round(g[t], 6), len(t), t)):
        if not any(s[:-1].startswith(x) or x.startswith(s[:-1]) for x in stems):
            stems.append(s[:-1])
    whole = [w for w in words if not any(w.startswith(s) for s in stems)]
    return sorted([(w, False) for w in whole] + [(s, True) for s in stems])


def held_out(id_col: str | Column, folds: int = 5) -> Column:
    """Whether a row's label is never learned from: crc32 of its id as text is a multiple of folds (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_training: int = MAX_TRAINING, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model learned from labelled rows of docs outside the held-out fold, about max_training of them at most.

    The sample goes by a hash of the id.  Terms are counted over it by Spark
    jobs, and only terms that a fixed share of toxic texts has, and one row
    of features and one signature a sampled text, come to the driver.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).alias("toxic"))
    n = known.count()
    if n > max_training:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * max_training / n))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id").select("toxic", "text")
    texts = cut_lineage(texts)
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    model = Model()
    model.weights[0] = math.log((toxic + 0.5) / (clean + 1.0))  # without terms or a class: the share of toxic texts
    if not toxic or not clean:
        model.weights[0] = min(-1.0, model.weights[0])
        return model
    least = max(MIN_TOXIC, math.ceil(MIN_SHARE * toxic))
    in_toxic = {r["term"]: r["n"] for r in term_counts(texts.where("toxic")).where(F.col("n") >= least).collect()}
    in_clean = {r["term"]: r["n"] for r in term_counts(texts.where("not toxic"), frozenset(in_toxic)).collect()}
    likely = frozenset(marking(in_toxic, in_clean, toxic, clean))
    in_toxic = {r["term"]: r["n"] for r in different_counts(texts.where("toxic"), likely).collect()}  # copies of one text count once
    model.terms = choose_terms(marking({t: a for t, a in in_toxic.items() if a >= least}, in_clean, toxic, clean), in_toxic)
    # Rows of one id or copies of one text, however many, are one row with its number.
    rows = feature_rows(texts, model.terms, [("toxic", "toxic")]).groupBy("toxic", "x").agg(F.count("*").alias("n")).orderBy("toxic", "x").collect()
    model.weights = fit(np.array([r["x"] for r in rows]), np.array([float(r["toxic"]) for r in rows]), np.array([float(r["n"]) for r in rows]))
    return model


def feature_rows(texts: DataFrame, terms: list[tuple[str, bool]], keep: list[tuple[str, str]]) -> DataFrame:
    def start():
        matcher = Matcher(terms)
        return lambda batch: (None, [[features(t, matcher) for t in batch]])

    return per_text(texts, keep, "text", "x array<double>", start)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, score (0 to 1), predicted (1 from 0.5 on).

    Only the text is looked at; null and empty texts have no terms and get
    the model's base score.  Repeated rows are kept, an empty table gives an
    empty result, other columns are not read.
    """

    def start():
        matcher = Matcher(model.terms)
        return lambda batch: (None, [[model.score(features(t, matcher)) for t in batch]])

    out = per_text(docs, [(id_col, "doc_id")], text_col, "score double", start)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that are not predicted toxic, all columns."""

    def start():
        matcher = Matcher(model.terms)

        def work(batch):
            keep = [i for i, t in enumerate(batch) if model.score(features(t, matcher)) < 0.5]
            return keep, [[batch[i] for i in keep]]

        return work

    rest = [(c, c) for c in docs.columns if c != text_col]
    return per_text(docs, rest, text_col, f"`{text_col}` string", start).select(*docs.columns)
