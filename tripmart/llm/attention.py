"""A small causal self-attention model over token classes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Positions of a window, width of the model, and the two levels of the output: GROUPS groups of MEMBERS classes.
WINDOW, WIDTH, GROUPS, MEMBERS = 32, 16, 32, 32
CLASSES = GROUPS * MEMBERS
#: A later window scores its last STRIDE positions; the ones before are context that the window before has scored.
STRIDE = 24
#: Logits are kept within this bound, so that sums of exponentials stay finite without subtracting maxima.
BOUND = 60.0
#: Share of the classes' overall frequencies that is mixed into every prediction.
MIX = 0.05
#: Windows attended together, and how many such batches share one output step.
BATCH, GATHER = 64, 8
#: Windows whose gradients are taken together, so that what is between fits a core's cache.
PART = 128
#: Bytes of arrays that a task keeps for its next ones.
KEPT = 8 << 20

SHAPES = {"embed": (CLASSES, WIDTH), "place": (WINDOW, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH), "value": (WIDTH, WIDTH), "out": (WIDTH, WIDTH),
          "group": (WIDTH, GROUPS), "group_bias": (GROUPS,), "member": (GROUPS, WIDTH, MEMBERS), "member_bias": (GROUPS, MEMBERS)}
CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))


def keep_memory() -> None:
    """Free one large array: from then on the C library keeps what smaller ones leave for the next ones, and does not give it back page by page."""
    np.empty(KEPT, np.uint8)


def bounded(logits: np.ndarray) -> np.ndarray | None:
    """Keep logits within BOUND, in place; which ones were, or None for all."""
    if not logits.size or -BOUND < logits.min() and logits.max() < BOUND:
        return None
    inside = np.abs(logits) < BOUND
    np.clip(logits, -BOUND, BOUND, out=logits)
    return inside


@dataclass
class Weights:
    """All weights in one vector, with a view for each part."""

    vector: np.ndarray

    def __post_init__(self):
        at = 0
        for name, shape in SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, self.vector[at:at + size].reshape(shape))
            at += size

    @classmethod
    def initial(cls, class_counts: np.ndarray, seed: int = 1) -> Weights:
        """Random weights whose output starts from the classes' shares."""
        r = np.random.default_rng(seed)
        w = cls(np.zeros(sum(int(np.prod(s)) for s in SHAPES.values()), np.float32))
        for name in ("embed", "place"):
            getattr(w, name)[:] = r.normal(0, 0.3, SHAPES[name])
        for name in ("query", "key", "value", "out"):
            getattr(w, name)[:] = r.normal(0, 0.3, SHAPES[name])
        w.group[:] = r.normal(0, 0.05, SHAPES["group"])
        w.member[:] = r.normal(0, 0.05, SHAPES["member"])
        counts = class_counts.reshape(GROUPS, MEMBERS) + 1.0
        w.group_bias[:] = np.log(counts.sum(1) / counts.sum())
        w.member_bias[:] = np.log(counts / counts.sum(1, keepdims=True))
        return w


def attend(w: Weights, x: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Outputs (windows, WINDOW, WIDTH) for class ids x (windows, WINDOW), and what the gradient needs (used in training)."""
    h = np.take(w.embed, x, axis=0)
    h += w.place
    rows = h.reshape(-1, WIDTH)
    # Queries, keys and values by one product, the queries scaled already.
    three = np.concatenate([w.query * w.query.dtype.type(WIDTH ** -0.5), w.key, w.value], 1)
    qkv = (rows @ three).reshape(*x.shape, 3 * WIDTH)
    q, k, v = (qkv[:, :, i:i + WIDTH] for i in range(0, 3 * WIDTH, WIDTH))
    a = np.matmul(q, k.transpose(0, 2, 1))
    inside = bounded(a)
    np.exp(a, out=a)
    a *= CAUSAL
    # The exponentials stay as they are; what they make is divided by their sums.
    share = 1 / (a.reshape(-1, WINDOW) @ np.ones((WINDOW, 1), a.dtype))
    m = np.matmul(a, v).reshape(-1, WIDTH)
    m *= share
    r = m @ w.out
    r += rows
    return r.reshape(h.shape), (x, rows, three, q, k, v, share, inside, a, m)


class Scorer:
    """The model's weights, rearranged for scoring.

    Vectors carry a last element of 1, by which products add biases and
    softmax sums; query and key, and value and output, are multiplied out beforehand.
    """

    def __init__(self, w: Weights, class_counts: np.ndarray):
        n = WIDTH + 1
        counts = class_counts + 1.0
        self.overall = (MIX * counts / counts.sum()).astype(np.float32)
        self.embed = np.ones((CLASSES, n), np.float32)
        self.embed[:, :WIDTH] = w.embed
        self.place = np.zeros((WINDOW, n), np.float32)
        self.place[:, :WIDTH] = w.place
        self.match, self.pass_on = np.zeros((n, n), np.float32), np.zeros((n, n), np.float32)
        self.match[:WIDTH, :WIDTH] = w.query @ w.key.T * WIDTH ** -0.5
        self.pass_on[:WIDTH, :WIDTH] = w.value @ w.out
        self.group = np.vstack([w.group, w.group_bias])
        self.member = np.concatenate([w.member, w.member_bias[:, None, :]], 1)
        self.ones = np.ones((MEMBERS, 1), np.float32)

    def attend(self, x: np.ndarray, first: int = 0) -> np.ndarray:
        """Output rows (windows * places from first on, WIDTH + 1) for class ids x (windows, WINDOW), masked to the past."""
        h = np.take(self.embed, x, axis=0)
        h += self.place
        rows = np.ascontiguousarray(h[:, first:]).reshape(-1, WIDTH + 1)
        a = np.matmul((rows @ self.match).reshape(len(h), -1, WIDTH + 1), h.transpose(0, 2, 1))
        bounded(a)
        np.exp(a, out=a)
        a *= CAUSAL[first:]
        m = np.matmul(a, h).reshape(-1, WIDTH + 1)
        m /= m[:, WIDTH:]
        m = m @ self.pass_on
        m += rows
        return m

    def _chosen(self, logits: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log softmax of each row at its target, of logits that are bounded first and used up."""
        bounded(logits)
        out = np.take(logits.reshape(-1), np.arange(0, logits.size, logits.shape[1]) + target)
        np.exp(logits, out=logits)
        return out - np.log((logits @ self.ones[:logits.shape[1]])[:, 0])

    def log_probability(self, r: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each target class given its output row."""
        group = (target // MEMBERS).astype(np.uint8)
        order = np.argsort(group, kind="stable")
        r, group, member = np.take(r, order, axis=0), group[order], (target % MEMBERS)[order]
        total = self._chosen(r @ self.group, group)
        cuts = np.searchsorted(group, np.arange(GROUPS + 1))
        logits = np.empty((len(r), MEMBERS), r.dtype)
        for g, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b:
                np.matmul(r[a:b], self.member[g], out=logits[a:b])
        total += self._chosen(logits, member)
        out = np.empty(len(r), np.float32)
        out[order] = total
        np.exp(out, out=out)
        out *= 1 - MIX
        out += self.overall[target]
        return np.log(out, out=out)

    def score(self, texts: list[np.ndarray], begin: int) -> np.ndarray:
        """Log probability (natural) of each text, an array of class ids."""
        each = self.positions(texts, begin)
        return np.bincount(np.repeat(np.arange(len(texts)), [len(t) for t in texts]), each, len(texts)) if texts else np.zeros(0)

    def positions(self, texts: list[np.ndarray], begin: int) -> np.ndarray:
        """Log probability (natural) of every id of all texts, one after the other: each is scored once, from overlapping windows.

        begin: the class that precedes each text.  Windows of all texts are
        batched; memory is bounded by the batch and the texts' ids.
        """
        lengths = np.array([len(t) for t in texts], np.int64)
        total, places = np.zeros(int(lengths.sum())), np.cumsum(lengths) - lengths
        if not texts:
            return total
        counts = windows_of(lengths)
        owner = np.repeat(np.arange(len(texts)), counts)
        start = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
        begins = np.concatenate([[0], np.cumsum(lengths + WINDOW + 1)])
        flat = np.full(begins[-1], begin, np.int16)  # each text after its begin, padded by a window
        for b, t in zip(begins, texts, strict=False):
            flat[b + 1:b + 1 + len(t)] = t
        step = np.arange(WINDOW + 1)
        rows, targets, at_places = [], [], []

        def flush() -> None:
            if rows:
                total[np.concatenate(at_places)] = self.log_probability(np.concatenate(rows), np.concatenate(targets))
            for x in (rows, targets, at_places):
                x.clear()

        # First windows score all of their places; later ones attend only from those that no window before has scored.
        for some, first in ((np.flatnonzero(start == 0), 0), (np.flatnonzero(start), WINDOW - STRIDE)):
            for i in range(0, len(some), BATCH):
                s, o = start[some[i:i + BATCH]], owner[some[i:i + BATCH]]
                ids = np.take(flat, (begins[o] + s)[:, None] + step)
                at = np.flatnonzero(s[:, None] + step[first:-1] < lengths[o][:, None])
                rows.append(np.take(self.attend(ids[:, :-1], first), at, axis=0))
                targets.append(ids[:, 1 + first:].reshape(-1)[at])
                at_places.append((places[o] + s + first)[at // (WINDOW - first)] + at % (WINDOW - first))
                if len(rows) == GATHER:
                    flush()
        flush()
        return total


def windows_of(lengths: np.ndarray) -> np.ndarray:
    """Number of windows over texts: the first scores all its positions, later ones their last STRIDE."""
    return 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE))


def loss_and_gradient(w: Weights, ids: np.ndarray, wanted: bool = True) -> tuple[float, np.ndarray]:
    """Mean negative log probability (0 if not wanted) of windows ids (windows, WINDOW + 1), but for ids -1 at their ends, and its gradient as one vector."""
    g, n = Weights(np.zeros_like(w.vector)), max(1, np.count_nonzero(ids[:, 1:] >= 0))
    # Biases ride along as a last element.
    group, member = np.vstack([w.group, w.group_bias]), np.concatenate([w.member, w.member_bias[:, None, :]], 1)
    sums = np.zeros_like(group), np.zeros_like(member), np.zeros((WIDTH, 3 * WIDTH), w.vector.dtype)
    loss = sum(add_gradient(w, group, member, ids[i:i + PART], n, g, sums, wanted) for i in range(0, len(ids), PART))
    g.group[:], g.group_bias[:] = sums[0][:WIDTH], sums[0][WIDTH]
    g.member[:], g.member_bias[:] = sums[1][:, :WIDTH], sums[1][:, WIDTH]
    g.query[:] = sums[2][:, :WIDTH] * w.vector.dtype.type(WIDTH ** -0.5)
    g.key[:], g.value[:] = sums[2][:, WIDTH:2 * WIDTH], sums[2][:, 2 * WIDTH:]
    return loss / n, g.vector


def add_gradient(w: Weights, group_out: np.ndarray, member_out: np.ndarray, ids: np.ndarray, n: int, g: Weights, sums: tuple[np.ndarray, ...], wanted: bool) -> float:
    """Add the gradient of some windows' part of a mean over n ids: to g, and to sums that of the two outputs and of query, key and value together.  Returns their loss."""
    r, (x, h, three, q, k, v, share, inside, a, m) = attend(w, np.maximum(ids[:, :-1], 0))
    one = r.dtype.type
    target = ids[:, 1:].reshape(-1)
    group = (target // MEMBERS).astype(np.int8)  # -1 where there is no id
    scored = np.argsort(group, kind="stable")
    cuts = np.cumsum(np.bincount(group + 1, minlength=GROUPS + 1))
    scored, cuts = scored[cuts[0]:], (cuts - cuts[0]).tolist()
    target, group = target[scored], group[scored]
    # A last element of 1, by which products add the biases and sum up their gradients.
    flat = np.ones((len(target), WIDTH + 1), one)
    flat[:, :WIDTH] = np.take(r.reshape(-1, WIDTH), scored, axis=0)
    ones, first, loss = np.ones((MEMBERS, 1), one), np.arange(0, len(target) * MEMBERS, MEMBERS), 0.0

    def errors(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Gradient of the mean loss by logits, which are used up; adds to the loss."""
        nonlocal loss
        bounded(logits)
        every, at = logits.reshape(-1), first + chosen
        if wanted:
            loss -= float(np.take(every, at).sum(dtype=np.float64))
        np.exp(logits, out=logits)
        total = logits @ ones[:logits.shape[1]]
        if wanted:
            loss += float(np.log(total).sum(dtype=np.float64))
        logits *= 1 / (total * one(n))
        every[at] -= one(1 / n)
        return logits

    p = errors(flat @ group_out, group)
    sums[0][:] += flat.T @ p
    back = p @ w.group.T
    parts = [(i, slice(low, high)) for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)) if low < high]
    logits = np.empty((len(target), MEMBERS), one)
    for i, at in parts:
        np.matmul(flat[at], member_out[i], out=logits[at])
    p = errors(logits, target % MEMBERS)
    more = np.empty_like(back)
    for i, at in parts:
        sums[1][i] += flat[at].T @ p[at]
        np.matmul(p[at], w.member[i].T, out=more[at])
    back += more
    dr = np.zeros((x.size, WIDTH), one)
    dr[scored] = back
    g.out[:] += m.T @ dr
    dm = dr @ w.out.T
    dm *= share
    # The mean of da under a is the product of dm and the outputs that a has made.
    mean = np.einsum("ij,ij->i", dm, m).reshape(*x.shape, 1)
    dm = dm.reshape(*x.shape, WIDTH)
    d = np.empty((*x.shape, 3 * WIDTH), one)
    np.matmul(a.transpose(0, 2, 1), dm, out=d[:, :, 2 * WIDTH:])
    ds = np.matmul(dm, v.transpose(0, 2, 1))
    ds -= mean
    ds *= a
    if inside is not None:
        ds *= inside
    np.matmul(ds, k, out=d[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=d[:, :, WIDTH:2 * WIDTH])
    d = d.reshape(-1, 3 * WIDTH)
    sums[2][:] += h.T @ d
    dh = d @ three.T
    dh += dr
    g.place[:] += dh.reshape(len(x), -1).sum(0).reshape(WINDOW, WIDTH)
    x = x.reshape(-1)
    order = np.argsort(x, kind="stable")
    x = x[order]
    starts = np.flatnonzero(np.diff(x, prepend=-1))
    g.embed[x[starts]] += np.add.reduceat(np.take(dh, order, axis=0), starts, axis=0)
    return loss


class Adam:
    """Steps of gradient descent with momenta, from given weights."""

    def __init__(self, w: Weights, rate: float):
        self.vector, self.rate, self.steps = w.vector.copy(), rate, 0
        self.first, self.second = np.zeros_like(self.vector), np.zeros_like(self.vector)

    def step(self, windows: np.ndarray) -> None:
        """One step on a batch of windows (n, WINDOW + 1)."""
        _, grad = loss_and_gradient(Weights(self.vector), windows, wanted=False)
        self.steps += 1
        self.first += np.float32(0.1) * (grad - self.first)
        self.second += np.float32(0.02) * (grad * grad - self.second)
        first, second = self.first / np.float32(1 - 0.9 ** self.steps), self.second / np.float32(1 - 0.98 ** self.steps)
        self.vector -= np.float32(self.rate) * first / (np.sqrt(second) + np.float32(1e-8))


def train(w: Weights, windows: np.ndarray, epochs: int = 1, batch: int = 32, rate: float = 0.02) -> Weights:
    """Weights after so many passes over the windows, in their order."""
    adam = Adam(w, rate)
    for _ in range(epochs):
        for i in range(0, len(windows), batch):
            adam.step(windows[i:i + batch])
    return Weights(adam.vector)
