"""Conversation repair against shortest paths over all edits, and by enumeration of edit strings."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from tripmart.llm import conversation_repair as cr
from tripmart.llm.queries import QUERIES

DDL = "conv_id long, turn long, role string, text string"
#: What follows each initial, by hand: the grammar's states.
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_s, turn_s = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{conv_s}:{turn_s}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        core = text.rstrip(BLANK)
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Dijkstra over (rows used, last initial), by cost and then audit; what is left of the rows comes along."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, kept = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, kept
        if (i, last) in done:
            continue
        done.add((i, last))
        for initial, role in (("u", "user"), ("a", "assistant")):
            if initial in NEXT[last]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, initial, (*kept, (role, ""))))
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, kept))
            if found[i] not in ("blank", "duplicate"):
                role, text, extra = rows[i][2], rows[i][3], 3 * (found[i] == "truncated")
                if role[:1] in NEXT[last]:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[:1], (*kept, (role, text))))
                for initial, name in (("u", "user"), ("a", "assistant")):
                    if initial in NEXT[last]:
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, initial, (*kept, (name, text))))


def expected(rows):
    after, out = damage(rows), {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        found = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = cheapest(own, found)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def result(df):
    return {r[0]: tuple(r)[1:] for r in cr.digests(cr.repair(cr.damaged(df))).collect()}


def made(seed, convs, most, spread=1):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", "So. ", "a. ", "b", "ü?", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    return [(c, t * spread if r.random() < 0.95 else None, r.choice(roles), r.choice(texts) if r.random() < 0.7 else f"text {c} {t}.")
            for c in range(convs) for t in range(r.randrange(1, most)) if r.random() < 0.9]


def test_same_as_shortest_paths(spark):
    rows = made(1, 150, 14) + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, 1, "assistant", "Ho.")]
    assert result(spark.createDataFrame(rows, DDL).repartition(5)) == expected(rows)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_blocks_give_the_same(spark, monkeypatch, block):
    monkeypatch.setattr(cr, "BLOCK", block)
    rows = made(2, 12, 60)
    assert result(spark.createDataFrame(rows, DDL).repartition(3)) == expected(rows)


def test_audits_are_the_least_of_all_edit_strings():
    """Every string over D, I, K, R up to a length, for every short sequence of roles."""
    def valid(audit, roles):
        last, i, cost = "", 0, 0
        for e in audit:
            if e == "I":
                last, cost = next(iter(x for x in NEXT[last] if x != "s")), cost + 3
                continue
            if i == len(roles):
                return None
            if e == "D":
                cost += 4
            elif e == "K":
                if roles[i] not in NEXT[last]:
                    return None
                last = roles[i]
            else:
                last, cost = next(iter(x for x in NEXT[last] if x != "s")), cost + 3
            i += 1
        return cost if i == len(roles) and last in ("", "a") else None

    strings = [x for n in range(7) for x in itertools.product("DIKR", repeat=n)]
    for roles in itertools.chain.from_iterable(itertools.product("sua", repeat=n) for n in range(4)):
        parse = cr.Parse(cr.BOTTOM)
        for i in roles:
            parse.feed(i, "")
        cost, audits = cr.joined([parse.ways()])
        assert (cost, "".join(audits)) == min((c, "".join(x)) for x in strings if (c := valid(x, roles)) is not None)


def test_equal_tops_accept_the_same_rest():
    """All stacks that can come up, told apart by what they accept: equal tops never differ."""
    found, todo = {cr.BOTTOM}, [cr.BOTTOM]
    while todo:
        stack = todo.pop()
        for symbol in "sua":
            for after in cr.AUTOMATON.after(stack, symbol):
                if after not in found:
                    found.add(after)
                    todo.append(after)
    assert len(found) < 20

    def accepts(stack, rest):
        tops = {stack}
        for symbol in rest:
            tops = {a for t in tops for a in cr.AUTOMATON.after(t, symbol)}
        return any(cr.AUTOMATON.after(t, cr.END) for t in tops)

    rests = ["".join(x) for n in range(7) for x in itertools.product("sua", repeat=n)]
    futures = {s: frozenset(x for x in rests if accepts(s, x)) for s in found}
    for a, b in itertools.combinations(found, 2):
        if a[0] == b[0]:
            assert futures[a] == futures[b]
    assert futures[cr.BOTTOM] == {x for x in rests if re.fullmatch("(s?(ua)+)?", x)}


def test_long_conversation_and_long_text(spark):
    r = random.Random(3)
    rows = [(1, t, r.choice(["user", "assistant"]), f"t{t}." if t % 11 else "same.") for t in range(9000)] + [(2, 0, "user", "x" * 2_000_000 + "."), (2, 1, "assistant", " " * 500_000 + "." + " " * 500_000)]
    got = result(spark.createDataFrame(rows, DDL).repartition(4))
    assert got == expected(rows)


def test_repaired_rows_edges_and_other_columns(spark):
    assert result(spark.createDataFrame([], DDL)) == {}
    dropped = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kept = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 > 4)
    rows = [(dropped, 0, "user", "Hi."), (kept, 0, "user", "Hi.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL + ", block string, copies int")
    assert result(df) == expected(rows)
    out = cr.repair(cr.damaged(df)).where(f"conv_id = {kept}").collect()
    assert [(r["seq"], r["edit"], r["role"], r["text"]) for r in out] == [(0, None, None, None), (1, "keep", "user", "Hi."), (2, "insert", "assistant", "")]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = QUERIES["op11_conversation_repair"](spark, sf)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == expected(rows)
