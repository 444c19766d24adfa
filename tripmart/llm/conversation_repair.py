"""Repair of conversations by generalised LR parsing of their roles with weighted edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import groupby
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Rules of the role grammar: an optional system turn, then pairs of user and assistant turns; or no turn at all.
GRAMMAR = (("talk", ()), ("talk", ("pairs",)), ("talk", ("s", "pairs")), ("pairs", ("u", "a")), ("pairs", ("pairs", "u", "a")))
END = "$"
ROLE = {"u": "user", "a": "assistant"}
#: Costs of edits, and of leaving in a turn that is cut off.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = frozenset({"su", "ua", "au"})
#: A conversation is parsed in blocks of so many turn numbers, which are put together afterwards.
BLOCK = 4096
#: Rows handled at a time, and rows after which what all parses share is set aside.
SLICE, SETTLE = 512, 64

BLANKS = r"[\x20\x09-\x0D]"
NOT_BLANK, ENDED = r"[^\x20\x09-\x0D]", rf"[.!?]{BLANKS}*+\z"

Stack = tuple  # (LR state, the stack below or None)


class Automaton:
    """SLR automaton of GRAMMAR; stacks share what is below their tops."""

    def __init__(self) -> None:
        start = ("start", (GRAMMAR[0][0],))
        self.rules = (start, *GRAMMAR)
        self.names = {n for n, _ in self.rules}
        self.follow = self._follow()
        first = self._closure({(0, 0)})
        self.states, self.goto = [first], {}
        for i, items in enumerate(self.states):  # grows while it is walked through
            for symbol in sorted({s for r, dot in items for s in self.rules[r][1][dot:dot + 1]}):
                after = self._closure({(r, dot + 1) for r, dot in items if self.rules[r][1][dot:dot + 1] == (symbol,)})
                if after not in self.states:
                    self.states.append(after)
                self.goto[i, symbol] = self.states.index(after)

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        todo = list(items)
        while todo:
            r, dot = todo.pop()
            for i, (name, _) in enumerate(self.rules):
                if (name,) == self.rules[r][1][dot:dot + 1] and (i, 0) not in items:
                    items.add((i, 0))
                    todo.append((i, 0))
        return frozenset(items)

    def _follow(self) -> dict[str, set[str]]:
        """Symbols that may come after each name.  Only the whole may be empty, so no rule begins with an empty name."""
        first: dict[str, set[str]] = {n: set() for n in self.names}
        follow: dict[str, set[str]] = {n: {END} if n == "start" else set() for n in self.names}
        for _ in range(len(self.rules) + 1):
            for name, body in self.rules:
                if body:
                    first[name] |= first.get(body[0], {body[0]})
                for i, symbol in enumerate(body):
                    if symbol in self.names:
                        follow[symbol] |= first.get(body[i + 1], {body[i + 1]}) if i + 1 < len(body) else follow[name]
        return follow

    @lru_cache(maxsize=None)  # noqa: B019 (one automaton, few stacks: left recursion keeps them short)
    def after(self, stack: Stack, symbol: str) -> tuple[Stack, ...]:
        """Stacks after all reductions that the symbol allows, and its shift; for END: the stack if the whole is accepted."""
        out, todo = [], [stack]
        while todo:
            at = todo.pop()
            state = at[0]
            if (state, symbol) in self.goto:
                out.append((self.goto[state, symbol], at))
            for r, dot in self.states[state]:
                name, body = self.rules[r]
                if dot == len(body) and symbol in self.follow[name]:
                    if name == "start":
                        out.append(stack)
                        continue
                    below = at
                    for _ in body:
                        below = below[1]
                    todo.append((self.goto[below[0], name], below))
        return tuple(out)


AUTOMATON = Automaton()
BOTTOM: Stack = (0, None)


def best(front: dict[int, tuple], stack: Stack, cost: int, audit: str) -> bool:
    """Keep the cheapest way (ties: the least audit) to a stack top.

    Stacks with equal tops take the same symbols from there on, whatever lies
    below (a test walks through all of them), so one of them is enough.  Of two audits over the
    same rows, neither of which is dearer, none is a prefix of the other, so
    their order stays when both go on in the same way.
    """
    old = front.get(stack[0])
    if old is None or (cost, audit) < (old[1], old[2]):
        front[stack[0]] = (stack, cost, audit)
        return True
    return False


def with_inserts(front: dict[int, tuple]) -> dict[int, tuple]:
    """The front and what insertions lead to from it."""
    todo = list(front.values())
    while todo:
        stack, cost, audit = todo.pop()
        if front[stack[0]] != (stack, cost, audit):
            continue
        for symbol in ROLE:
            for after in AUTOMATON.after(stack, symbol):
                if best(front, after, cost + INSERT, audit + "I"):
                    todo.append(front[after[0]])
    return front


def consumed(front: dict[int, tuple], initial: str, fault: str) -> dict[int, tuple]:
    """The front after one more row, given the initial of its role and its fault ("" for none)."""
    out: dict[int, tuple] = {}
    extra = TRUNCATED if fault == "truncated" else 0
    for stack, cost, audit in front.values():
        best(out, stack, cost + DELETE, audit + "D")
        if fault not in ("blank", "duplicate"):
            for after in AUTOMATON.after(stack, initial) if initial in ("s", *ROLE) else ():
                best(out, after, cost + extra, audit + "K")
            for symbol in ROLE:
                for after in AUTOMATON.after(stack, symbol):
                    best(out, after, cost + REROLE + extra, audit + "R")
    return with_inserts(out)


@dataclass
class Parse:
    """Cheapest edits of the rows so far, from one stack to every stack top that they lead to."""

    start: Stack
    settled: list[str] = field(default_factory=list)
    rows: int = 0

    def __post_init__(self) -> None:
        self.front = with_inserts({self.start[0]: (self.start, 0, "")})

    def feed(self, initial: str, fault: str) -> None:
        self.front = consumed(self.front, initial, fault)
        self.rows += 1
        if self.rows % SETTLE == 0 and (shared := commonprefix([a for *_, a in self.front.values()])):
            self.settled.append(shared)
            self.front = {t: (s, c, a[len(shared):]) for t, (s, c, a) in self.front.items()}

    def ways(self) -> list[tuple[int, int, int, str]]:
        """(top before, top after, cost, audit)."""
        head = "".join(self.settled)
        return [(self.start[0], top, cost, head + audit) for top, (_, cost, audit) in sorted(self.front.items())]


@lru_cache(maxsize=1)
def stacks() -> dict[int, Stack]:
    """One stack for each top that can be on one when a row begins."""
    found, todo = {BOTTOM[0]: BOTTOM}, [BOTTOM]
    while todo:
        stack = todo.pop()
        for symbol in ("s", *ROLE):
            for after in AUTOMATON.after(stack, symbol):
                if after[0] not in found:
                    found[after[0]] = after
                    todo.append(after)
    return found


def joined(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[str]]:
    """(cost, audit of each block) of the cheapest edits over all blocks' ways, in order."""
    front: dict[int, tuple[int, list[str]]] = {BOTTOM[0]: (0, [])}
    for ways in blocks:
        out: dict[int, tuple[int, list[str]]] = {}
        for before, after, cost, audit in ways:
            if before in front:
                way = (front[before][0] + cost, [*front[before][1], audit])
                old = out.get(after)
                if old is None or way[0] < old[0] or way[0] == old[0] and "".join(way[1]) < "".join(old[1]):
                    out[after] = way
        front = out
    whole = [way for top, way in front.items() if AUTOMATON.after(stacks()[top], END)]
    return min(whole, key=lambda w: (w[0], "".join(w[1])))


SUMMARY = ("block long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
           "ways array<struct<before:int,after:int,cost:long,audit:string>>")
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Block:
    """Faults and cheapest edits of one block, fed with its rows in order."""

    def __init__(self, block: int, alone: bool):
        self.block = block
        self.parses = [Parse(s) for s in ([BOTTOM] if alone else stacks().values())]
        self.seen: set[tuple[str, bytes]] = set()
        self.low = self.high = None
        self.turns = self.illegal = 0
        self.faults = {"": 0, "blank": 0, "duplicate": 0, "truncated": 0}
        self.first = self.last = None

    def feed(self, turn: int | None, role: str, digest: bytes, blank: bool, ended: bool, seen_before: bool, copies: int) -> None:
        for _ in range(copies):
            if turn is not None and turn != self.high:
                self.low = turn if self.low is None else self.low
                self.high, self.turns = turn, self.turns + 1
            initial = role[:1]
            if self.last is None:
                self.first = initial
            else:
                self.illegal += self.last + initial not in LEGAL
            self.last = initial
            key = (role, digest)
            fault = "blank" if blank else "duplicate" if seen_before or key in self.seen else "" if ended else "truncated"
            self.seen.add(key)
            self.faults[fault] += 1
            for parse in self.parses:
                parse.feed(initial, fault)

    def summary(self) -> dict:
        ways = [{"before": b, "after": a, "cost": c, "audit": x} for p in self.parses for b, a, c, x in p.ways()]
        counts = {k: v for k, v in self.faults.items() if k}
        return {"block": self.block, "low": self.low, "high": self.high, "turns": self.turns, **counts, "illegal": self.illegal, "first": self.first, "last": self.last, "ways": ways}


def report(summaries: list[dict]) -> tuple[dict, list[str]]:
    """(report, audit of each block) of a conversation from its blocks' summaries, in order."""
    held = [s for s in summaries if s["first"] is not None]
    out = {k: sum(s[k] for s in held) for k in ("blank", "duplicate", "truncated", "illegal")}
    out["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(held, held[1:], strict=False))
    low, high = [s["low"] for s in held if s["low"] is not None], [s["high"] for s in held if s["high"] is not None]
    out["gaps"] = max(high) - min(low) + 1 - sum(s["turns"] for s in held) if low else 0
    if not held:
        return {**out, "cost": 0, "audit": ""}, [""] * len(summaries)
    cost, audits = joined([[tuple(w[k] for k in ("before", "after", "cost", "audit")) for w in s["ways"]] for s in summaries])
    return {**out, "cost": cost, "audit": "".join(audits)}, audits


def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            yield from whole.slice(at, SLICE).to_pylist()


def in_batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of rows, bounded by number and by length of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("text") or "")
        if len(held) >= 8 * SLICE or size > 1 << 24:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema)


def damaged(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by the checksum of their id and turn, nulls being one space.

    Of 20 remainders, 0 drops a row (copies: 0), 1 empties its text, 2 takes
    full stops, exclamation and question marks out, 3 doubles it, 4 makes the user its speaker.
    """
    space = F.lit(" ")
    said = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(said(id_col), F.lit(":"), said(turn_col)).cast("binary")) % 20
    rows = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def seen_in_earlier_blocks(rows: DataFrame) -> DataFrame:
    """rows with `first_block`: where role and text occur first, in conversations of several blocks; null in others."""
    held = rows.where("copies > 0")
    several = held.groupBy("conv_id").agg(F.min("block").alias("low"), F.max("block").alias("high")).where("low < high").select(F.col("conv_id").alias("id"))
    if several.isEmpty():
        return rows.withColumn("first_block", F.lit(None).cast("long"))
    of_several = held.join(several, F.col("conv_id").eqNullSafe(F.col("id")), "left_semi")
    first = of_several.groupBy(F.col("conv_id").alias("id"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min("block").alias("first_block"))
    # Rows without copies say the same of their conversation.
    bare = of_several.select(F.col("conv_id").alias("id")).distinct().select("id", F.lit(None).cast("string").alias("r"), F.lit(None).cast("binary").alias("d"), F.lit(-(1 << 62)).alias("first_block"))
    same = F.col("conv_id").eqNullSafe(F.col("id")) & F.when(F.col("copies") > 0, F.col("role")).eqNullSafe(F.col("r")) & F.when(F.col("copies") > 0, F.col("digest")).eqNullSafe(F.col("d"))
    return rows.join(first.unionByName(bare), same, "left").drop("id", "r", "d")


def repair(rows: DataFrame) -> DataFrame:
    """Conversations repaired at least cost, from rows (conv_id, turn, role, text, copies).

    One row per conversation with its report (seq 0), then the repaired turns
    (seq from 1): conv_id, seq, edit (keep, rerole, insert), role, text,
    report.  A conversation's rows are together and in order within a partition.

    Rows go by turn (nulls first), then role, then digest of the text; a row
    stands for as many equal ones as it has copies, and one of 0 copies only
    names its conversation.  Rows with a null id are one conversation.

    Rows meet without their texts first: each block of BLOCK turn numbers is
    parsed from every stack top that it may begin with, so that a long
    conversation is parsed by many tasks.  Then texts join their blocks'
    summaries in one pass that holds no more than these; a conversation's
    rows come out of one task, one after the other.
    """
    conv = rows.schema["conv_id"]
    block = F.floor(F.coalesce("turn", F.lit(-(1 << 62))) / BLOCK).cast("long")
    rows = rows.withColumns({"block": block, "digest": F.unhex(F.sha2(F.col("text").cast("binary"), 256))})
    bare: list[Column] = [~F.col("text").rlike(NOT_BLANK), F.col("text").rlike(ENDED)]
    light = rows.select("conv_id", "block", "turn", "role", "digest", bare[0].alias("blank"), bare[1].alias("ended"), "copies")
    light = seen_in_earlier_blocks(light).repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", F.asc_nulls_first("turn"), "role", "digest")
    summary_type = StructType.fromDDL(SUMMARY)
    summary_schema = StructType([conv, StructField("summary", summary_type)])
    arrow_summary = to_arrow_schema(summary_schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[dict]:
            for (conv_id, number), own in groupby(stream(batches), lambda r: (r["conv_id"], r["block"])):
                block = None
                for r in own:
                    block = block or Block(number, r["first_block"] is None)
                    block.feed(r["turn"], r["role"], r["digest"], r["blank"], r["ended"], r["first_block"] is not None and r["first_block"] < number, r["copies"])
                yield {"conv_id": conv_id, "summary": block.summary()}

        yield from in_batches(blocks(), arrow_summary)

    summaries = light.mapInArrow(parse, summary_schema)
    nothing = {"turn": "long", "role": "string", "digest": "binary", "text": "string", "copies": "int"}
    heads = summaries.select("conv_id", F.lit(0).alias("kind"), F.col("summary.block").alias("block"), *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()), "summary")
    texts = rows.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "block", *nothing, F.lit(None).cast(summary_type).alias("summary"))
    every = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "block", F.asc_nulls_first("turn"), "role", "digest")
    every = every.select("conv_id", "block", "role", "text", "copies", "summary")
    out_schema = StructType([conv, *StructType.fromDDL(f"seq long, edit string, role string, text string, report struct<{REPORT}>").fields])
    arrow_out = to_arrow_schema(out_schema)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[dict]:
            for conv_id, own in groupby(stream(batches), lambda r: r["conv_id"]):
                found = []
                row = next(own)
                while row is not None and row["summary"] is not None:
                    found.append(row["summary"])
                    row = next(own, None)
                what, audits = report(found)
                yield {"conv_id": conv_id, "seq": 0, "report": what}
                seq, last = 0, ""
                for summary, audit in zip(found, audits, strict=True):
                    copy = 0
                    for edit in audit:
                        if edit == "I":
                            role, text = ROLE["u" if last != "u" else "a"], ""
                        else:
                            role, text = row["role"], row["text"]
                            if row["block"] != summary["block"]:
                                raise ValueError("rows of a block are out of step with its parse")
                            copy += 1
                            if copy == row["copies"]:
                                row, copy = next(own, None), 0
                            if edit == "D":
                                continue
                            if edit == "R":
                                role = ROLE["u" if last != "u" else "a"]
                        seq, last = seq + 1, role[:1]
                        yield {"conv_id": conv_id, "seq": seq, "edit": {"K": "keep", "R": "rerole", "I": "insert"}[edit], "role": role, "text": text}

        yield from in_batches(turns(), arrow_out)

    return every.mapInArrow(rewrite, out_schema)


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: its report, and repaired_sha256 of its turns `role:text` joined by newlines.

    A digest goes over a conversation turn by turn as they come, in the order
    and the partitions that `repair` leaves them in; no turn is held.
    """
    conv = repaired.schema["conv_id"]
    fields = StructType([conv, *StructType.fromDDL(f"{REPORT}, repaired_sha256 string").fields])
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            now, digest = None, hashlib.sha256()
            for r in stream(batches):
                if r["seq"] == 0:
                    if now:
                        yield {**now, "repaired_sha256": digest.hexdigest()}
                    now, digest = {"conv_id": r["conv_id"], **r["report"]}, hashlib.sha256()
                else:
                    digest.update(f"{chr(10) * (r['seq'] > 1)}{r['role']}:{r['text']}".encode())
            if now:
                yield {**now, "repaired_sha256": digest.hexdigest()}

        yield from in_batches(rows(), arrow)

    return repaired.mapInArrow(run, fields)
