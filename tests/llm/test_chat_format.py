"""Chat windows: exact round trips, budgets, history and masks, against a plain version."""

import hashlib
import random

import pytest
import regex
from pyspark.sql import functions as F

from tripmart.llm import chat_format
from tripmart.llm.queries import QUERIES

DDL = "conv_id long, turn long, role string, text string"
PIECES = ["<|start|>", "<|message|>", "<|end|>", "<\\|end|>", "<\\\\|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>", "<", "[", "\\", "$1", "\n", " ", "word", "größe", "𝔘", "<|start", "end|>", "<\\"]


def order(r):
    return (r[1] is not None, r[1] or 0, (r[2] or "") != "system", r[2] or "", r[3] or "")


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        under = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest())
    return out


def digests(df, **kw):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_format.digests(chat_format.chat_windows(df, **kw)).collect()}


@pytest.fixture(scope="module")
def hostile():
    r = random.Random(5)
    text = lambda: None if r.random() < 0.05 else "".join(r.choice(PIECES) for _ in range(r.randrange(0, 12)))
    rows = [(c, t, r.choice(["user", "assistant", "system" if t == 0 else "user", "<|end|>", "a\nb"]), text()) for c in range(30) for t in range(r.randrange(1, 14))]
    return [*rows, (None, 0, "user", "x"), (None, 1, "assistant", "y"), (40, None, None, None), (41, None, "assistant", "b"), (41, None, "assistant", "a"), (41, 3, "system", "s"), (41, 3, "assistant", "c"), (41, 3, "assistant", "c"), (42, 0, "system", "only")]


@pytest.mark.parametrize("kw", [{}, {"budget": 24, "history": 12}, {"budget": 1, "history": 0}, {"budget": 30, "history": 10, "block": 3}])
def test_read_back_is_what_went_in(spark, hostile, kw):
    df = spark.createDataFrame(hostile, DDL).repartition(3)
    assert digests(df, **kw) == expected(hostile)


def test_windows_are_within_budget_and_repeat_history_masked(spark):
    r = random.Random(6)
    rows = [(c, t, "system" if t == 0 and c % 2 else "user" if t % 2 else "assistant", " ".join("wo" for _ in range(r.randrange(1, 20)))) for c in range(12) for t in range(40)]
    budget, history = 100, 30
    windows = chat_format.chat_windows(spark.createDataFrame(rows, DDL), budget, history)
    turns = windows.select("*", F.split("text", r"<\|start\|>").alias("parts")).orderBy("conv_id", "window").collect()
    for conv in range(12):
        mine = [w for w in turns if w["conv_id"] == conv]
        assert [w["window"] for w in mine] == list(range(1, len(mine) + 1)) and len(mine) > 3
        seen = []
        for w in mine:
            pieces = w["parts"][1:]
            assert len(pieces) == w["n_turns"] and w["n_tokens"] <= budget
            fresh, again = pieces[w["n_repeated"]:], pieces[:w["n_repeated"]]
            assert fresh
            system = [p for p in again if p.startswith("system")]
            assert len(system) == (conv % 2 and w["window"] > 1)
            tail = again[len(system):]
            assert tail == (seen[-len(tail):] if tail else [])
            # As much history as fits: one turn more would begin too early.
            if w["window"] > 1:
                longer = [p for p in seen if not p.startswith("system")][-len(tail) - 1:]
                assert len(longer) == len(tail) or len(longer) == len(tail) + 1
                if len(longer) > len(tail):
                    sizes = sizes_of(longer)
                    assert sum(sizes[1:]) <= history < sum(sizes)
            seen += fresh
            # The mask covers the new assistant texts and nothing else.
            under = [w["text"][s["start"]:s["end"]] for s in w["loss"]]
            assert under == [p.split("<|message|>")[1].removesuffix("<|end|>") for p in fresh if p.startswith("assistant")]
        assert len(seen) == 40


def sizes_of(pieces):
    return [sum(len(regex.findall(chat_format.TOKEN, x)) for x in p.removesuffix("<|end|>").split("<|message|>")) + chat_format.MARKS for p in pieces]


def test_long_conversation_is_cut_into_blocks_with_its_system_turn(spark):
    rows = [(7, t, "system" if t == 0 else "user" if t % 2 else "assistant", f"t{t}") for t in range(100)] + [(8, 0, "user", "q"), (8, 1, "assistant", "a")]
    windows = chat_format.chat_windows(spark.createDataFrame(rows, DDL), block=16).collect()
    long = sorted((w for w in windows if w["conv_id"] == 7), key=lambda w: (w["block"], w["window"]))
    assert {w["block"] for w in long} == set(range(7)) and all(w["cut"] for w in long)
    assert all(w["text"].startswith("<|start|>system<|message|>t0<|end|>") for w in long)
    assert [w["n_repeated"] for w in long] == [0] + [1] * 6
    assert [w["cut"] for w in windows if w["conv_id"] == 8] == [False]


def test_escapes_are_inverse_and_long_texts_pass(spark):
    r = random.Random(7)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randrange(0, 20))) for _ in range(300)] + ["<" * 300_000, "<" + "\\" * 300_000, "[" + "\\" * 300_000 + "INST]", "<|" + "a" * 300_000, "wo " * 300_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat_format.escape(F.col("t")).alias("e"))
    rows = df.select("t", "e", chat_format.unescape(F.col("e")).alias("u")).collect()
    assert all(r["u"] == r["t"] for r in rows)
    assert not any(m in r["e"] for r in rows for m in (chat_format.START, chat_format.MESSAGE, chat_format.END, "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))
    big = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts[-5:])]
    assert digests(spark.createDataFrame(big, DDL)) == expected(big)


def test_empty_table_and_other_columns(spark):
    assert chat_format.chat_windows(spark.createDataFrame([], DDL)).count() == 0
    rows = [(1, 0, "user", "q", "x", 1), (1, 1, "assistant", "a", "y", 2)]
    df = spark.createDataFrame(rows, DDL + ", block string, window int")
    assert digests(df) == expected([r[:4] for r in rows])


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, t, role, "</s>[INST] ok [/INST]") for t, role in enumerate(("user", "assistant"))]
    out = QUERIES["op13_chat_formatting"](spark, sf)
    assert out.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    got = out.collect()
    assert {r[0]: tuple(r)[1:5] for r in got} == expected(rows)
    assert all(r["formatted_chars"] > sum(len(x[3]) for x in rows if x[0] == r["conv_id"]) for r in got)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "InArrow" not in plan
