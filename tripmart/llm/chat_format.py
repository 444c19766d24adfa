"""Conversations as training texts: budgeted windows of whole turns, with masks of the targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Marks around a turn: START role MESSAGE text END.
START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
#: Control strings of this and other common templates, with any number of backslashes after the bracket.
#: Their bodies hold no opening bracket, so that no two matches overlap.
CONTROL = r"([<\[])(\\{least},}+)(\|[A-Za-z0-9_]++\|>|/?s>|/?INST\]|/?SYS>>)"
#: Tokens of a window at most, unless a single turn is larger, and those repeated from the window before.
BUDGET, HISTORY = 1024, 256
#: What counts as one token: up to four letters, up to three digits, or one other visible character.
TOKEN = r"\p{L}{1,4}+|\p{N}{1,3}+|[^\s\p{L}\p{N}]"
#: Tokens of a turn's marks.
MARKS = 3
#: A conversation of more rows is cut into blocks of so many turn numbers, so that no task gets all of it.
BLOCK = 16_384
#: Ids of such conversations go to all tasks up to this many; beyond, they are joined by key.
MAX_BROADCAST = 100_000

TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"


def escape(c: Column) -> Column:
    """Text without control strings: each one gets one more backslash after its bracket."""
    return F.regexp_replace(c, CONTROL.replace("{least}", "{0"), r"$1\\$2$3")


def unescape(c: Column) -> Column:
    """The text that was escaped: each backslashed control string loses one backslash."""
    return F.regexp_replace(c, CONTROL.replace("{least}", "{1").replace(r"(\\{1,}+)", r"\\(\\*+)"), "$1$2$3")


def tokens(c: Column) -> Column:
    return F.regexp_count(c, F.lit(TOKEN)).cast("long")


def long_conversations(rows: DataFrame, block: int) -> DataFrame | None:
    """Ids (`long_id`) of conversations of more rows than a block, if there are any; fewer than one for each block of rows."""
    ids = rows.groupBy(F.col("conv_id").alias("long_id")).agg(F.count("*").alias("n")).where(F.col("n") > block).select("long_id")
    n = ids.count()
    return None if n == 0 else F.broadcast(ids) if n <= MAX_BROADCAST else ids


def in_blocks(rows: DataFrame, long_ids: DataFrame, block: int) -> DataFrame:
    """rows with `cut` (whether the conversation is long) and `block`, the system turn going along into every later block of its conversation."""
    marked = rows.join(long_ids.withColumn("cut", F.lit(True)), F.col("conv_id").eqNullSafe(F.col("long_id")), "left").drop("long_id")
    number = F.coalesce(F.floor(F.col("turn") / block).cast("long"), F.lit(-(1 << 62)))
    marked = marked.withColumn("cut", F.coalesce("cut", F.lit(False))).withColumn("block", F.when(F.col("cut"), number).otherwise(F.lit(0).cast("long")))
    long_rows = marked.where("cut")
    order = F.struct(F.coalesce("turn", F.lit(-(1 << 63))).alias("turn"))
    blocks = long_rows.groupBy("conv_id", "block").agg(F.min(order).alias("first"))
    first = blocks.groupBy("conv_id").agg(F.min("block").alias("first_block"), F.min("first").alias("first"))
    systems = long_rows.where(F.col("role") == SYSTEM_ROLE).groupBy("conv_id").agg(F.min(F.struct(order.alias("first"), F.col("text"))).alias("s"))
    kept = first.alias("f").join(systems.alias("y"), F.col("f.conv_id").eqNullSafe(F.col("y.conv_id")) & (F.col("f.first") == F.col("y.s.first")))
    kept = kept.select(F.col("f.conv_id").alias("system_id"), "first_block", "s.text")
    copies = blocks.join(kept, F.col("conv_id").eqNullSafe(F.col("system_id")) & (F.col("block") > F.col("first_block")))
    copies = copies.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(SYSTEM_ROLE).alias("role"), "text", F.lit(True).alias("context"), F.lit(True).alias("cut"), "block")
    return marked.unionByName(copies)


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, block: int = BLOCK,
                 id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: conv_id, cut, block, window, text, loss, n_turns, n_repeated, n_tokens.

    Turns go by turn number, nulls first, then a system turn before others,
    then role and text.  A running sum of their tokens is cut at multiples of
    a stride, and a window holds the turns that begin between two cuts: whole
    turns, each new in one window.  In front of them a window repeats the
    conversation's system turn, if that comes first, and the turns that begin
    in the `history` tokens before.  The stride leaves room for these and for
    the longest turn, so a window has more than `budget` tokens only if
    longest turn, system turn and history together have.

    loss: (start, end) in code points of text, end exclusive, of the
    assistant texts that are new in the window; repeated ones are masked.
    Control strings in roles and texts are escaped; `unescape` is the inverse.
    n_repeated counts the turns in front that an earlier window had first.

    A conversation of more rows than `block` is cut at multiples of `block` turn
    numbers first (cut: true); each block has the system turn, but no history
    from the one before.  Rows of one turn number stay together.  Null roles
    and texts count as empty, rows with a null id are one conversation,
    repeated rows are repeated turns, an empty table gives no windows; other
    columns are not read.
    """
    rows = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.lit(False).alias("context"))
    long_ids = long_conversations(rows, block)
    keys = ["conv_id", "block"] if long_ids is not None else ["conv_id"]
    if long_ids is not None:
        rows = in_blocks(rows, long_ids, block)

    # Escaped and counted where the rows are read, so that the exchange carries each text once.
    rows = rows.withColumns({"size": tokens(F.col("role")) + tokens(F.col("text")) + MARKS, "text": escape(F.col("text")), "later": F.col("role") != SYSTEM_ROLE})
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy(F.desc("context"), F.asc_nulls_first("turn"), "later", "role", "text")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.row_number().over(ordered))
    rows = rows.withColumn("fixed", (F.col("place") == 1) & (F.col("role") == SYSTEM_ROLE))
    rows = rows.withColumn("own", F.when(F.col("fixed"), F.lit(0)).otherwise(F.col("size")))
    rows = rows.withColumns({"before": F.coalesce(F.sum("own").over(earlier), F.lit(0)), "longest": F.max("own").over(whole), "system": F.max(F.when(F.col("fixed"), F.col("size")).otherwise(F.lit(0))).over(whole)})
    stride = F.greatest(F.lit(budget - history) - F.col("longest") - F.col("system"), F.lit(1))
    rows = rows.withColumn("span", F.when(~F.col("fixed"), F.floor(F.col("before") / stride)))
    rows = rows.withColumn("fresh", F.when(F.col("fixed"), F.lit(0)).otherwise((~F.col("span").eqNullSafe(F.lag("span").over(ordered))).cast("int")))
    rows = rows.withColumn("first", F.sum("fresh").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    reach = whole.orderBy("before").rangeBetween(0, history)
    rows = rows.withColumn("last", F.when(F.col("fixed"), F.greatest(F.max("first").over(whole), F.lit(1))).otherwise(F.max("first").over(reach)))
    rows = rows.withColumn("first", F.greatest("first", F.lit(1)))

    turns = rows.withColumn("window", F.explode(F.sequence("first", "last")))
    turns = turns.withColumns({"head": F.concat(F.lit(START), escape(F.col("role")), F.lit(MESSAGE)), "new": (F.col("window") == F.col("first")) & ~F.col("context")})
    length = F.length("head") + F.length("text") + len(END)
    inside = Window.partitionBy(*keys, "window").orderBy("place")
    turns = turns.withColumn("at", F.coalesce(F.sum(length).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head"))
    span = F.when(F.col("new") & (F.col("role") == TARGET_ROLE), F.struct(F.col("at").alias("start"), (F.col("at") + F.length("text")).alias("end")))
    piece = F.struct("place", F.concat("head", "text", F.lit(END)).alias("piece"), span.alias("span"))
    grouped = turns.groupBy(*keys, "window").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"), F.count("*").alias("n_turns"),
        F.count_if(~F.col("new")).alias("n_repeated"), F.sum("size").alias("n_tokens"),
        F.first("cut").alias("cut") if "cut" in rows.columns else F.lit(False).alias("cut"))
    return grouped.select("conv_id", "cut", F.col("block") if "block" in keys else F.lit(0).cast("long").alias("block"), "window",
                          F.array_join("pieces.piece", "").alias("text"), F.filter("pieces.span", lambda s: s.isNotNull()).alias("loss"), "n_turns", "n_repeated", "n_tokens")


def read_turns(text: Column, n_repeated: Column) -> Column:
    """The (role, text) of a window's new turns, unescaped, read back from its text."""
    parts = F.split(text, r"<\|start\|>", -1)
    fresh = F.slice(parts, n_repeated.cast("int") + 2, F.size(parts))

    def turn(p: Column) -> Column:
        at = F.instr(p, MESSAGE)
        body = F.substring(p, at + len(MESSAGE), F.length(p) - at - (len(MESSAGE) + len(END) - 1))
        return F.struct(unescape(F.substring(p, F.lit(1), at - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(fresh, turn)


def loss_text(text: Column, loss: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, all read back from its windows: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A conversation that is not cut is put together where its windows are;
    the windows of a long one move to one task, as a digest of the whole needs it in one row.
    """
    turns = read_turns(F.col("text"), F.col("n_repeated"))
    read = windows.withColumns({"turns": turns, "under": loss_text(F.col("text"), F.col("loss"))})
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = F.struct("block", "window", F.size("turns").cast("long").alias("n"), written.alias("turns"), "under", F.length("text").cast("long").alias("chars"))

    def together(some: DataFrame, *keys: str) -> DataFrame:
        parts = some.select("conv_id", "block", part.alias("p")).groupBy(*keys).agg(F.array_sort(F.collect_list("p")).alias("p"))
        total = lambda c: F.aggregate(f"p.{c}", F.lit(0).cast("long"), lambda a, x: a + x)
        under = F.array_join("p.under", "")
        return parts.select("conv_id", total("n").alias("n_turns"), F.sha2(F.array_join("p.turns", "").cast("binary"), 256).alias("turns_sha256"),
                            F.length(under).cast("long").alias("loss_chars"), F.sha2(under.cast("binary"), 256).alias("loss_sha256"), total("chars").alias("formatted_chars"))

    return together(read.where("not cut"), "conv_id", "block").unionByName(together(read.where("cut"), "conv_id"))
