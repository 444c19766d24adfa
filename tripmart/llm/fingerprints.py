"""Document fingerprints: a homomorphic multiset hash of paragraphs, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.graph import cut_lineage

#: 32-bit sums of a paragraph's own hashes: equality of whole texts up to the order of paragraphs.
STRONG = 8
#: Longs with two 32-bit counters each, of the set bits of hashes of a paragraph's word windows: likeness.
PAIRS = 64
#: Words hashed together.
WIDTH = 3
LANES = 0x0000000100000001
LOW = 0xFFFFFFFF
SUMS = [*(f"s{i}" for i in range(STRONG)), *(f"c{i}" for i in range(PAIRS)), "units"]


def sums(texts: DataFrame, keys: list[str], text_col: str, also: Sequence[str] = ()) -> DataFrame:
    """keys, also (columns that the keys determine) and the vector SUMS of each text: the sum over its paragraphs of a wide vector hashed from each.

    A paragraph is a line, a word a run between single spaces, a unit the
    window of up to WIDTH words from each word of the paragraph on.  The
    vector of a paragraph is its STRONG hashes, and the counts of set bits of
    its units' hashes and of the units: a function of the paragraph alone, so that
    vectors of texts add and subtract as their multisets of paragraphs do.
    """
    lines = texts.select(*keys, *also, F.explode(F.split(text_col, "\n")).alias("line"))
    strong = [F.xxhash64("line", F.lit(i)).bitwiseAND(F.lit(LOW)).alias(f"s{i}") for i in range(STRONG)]
    lines = lines.select(*keys, *also, *strong, F.split("line", " ").alias("w"))
    windows = F.arrays_zip(*(F.slice("w", i + 1, F.size("w")).alias(f"w{i}") for i in range(WIDTH)))
    units = lines.select(*keys, *also, *(f"s{i}" for i in range(STRONG)), F.posexplode(windows).alias("pos", "u"))
    first = F.xxhash64(*(F.col(f"u.w{i}") for i in range(WIDTH)))
    units = units.select(*keys, *also, *(F.when(F.col("pos") == 0, F.col(f"s{i}")).otherwise(F.lit(0)).alias(f"s{i}") for i in range(STRONG)), first.alias("h0"))
    units = units.withColumn("h1", F.xxhash64("h0"))
    counts = [F.sum(F.shiftright(f"h{i // 32}", i % 32).bitwiseAND(F.lit(LANES))).alias(f"c{i}") for i in range(PAIRS)]
    return units.groupBy(*keys).agg(*(F.max(c).alias(c) for c in also), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(STRONG)), *counts, F.count("*").alias("units"))


def vector() -> Column:
    """The columns SUMS as one struct (s: hashes, c: counts, units), for expressions that walk through arrays."""
    return F.struct(F.array(*(f"s{i}" for i in range(STRONG))).alias("s"), F.array(*(f"c{i}" for i in range(PAIRS))).alias("c"), F.col("units").alias("units"))


def as_text(x: str) -> Column:
    """The vector modulo 2**32 (hashes, and counts two to a long) as hex digits."""
    strong = F.transform(f"{x}.s", lambda v: F.lpad(F.hex(v.bitwiseAND(F.lit(LOW))), 8, "0"))
    counts = F.transform(f"{x}.c", lambda v: F.lpad(F.hex(v), 16, "0"))
    return F.lower(F.concat(F.array_join(strong, ""), F.array_join(counts, "")))


def likeness(a: str, b: str) -> Column:
    """0 to 1: twice the inner product of two texts' vectors over the sum of their squares.

    The counts of set bits less half of the units are sums of random signs, so
    that inner products estimate those of the multisets of units.
    """

    def low(v: Column) -> Column:
        return v.bitwiseAND(F.lit(LOW)).cast("double")

    def high(v: Column) -> Column:
        return F.shiftrightunsigned(v, 32).cast("double")

    def total(terms: Column) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)

    def product(p: str, q: str) -> Column:
        """Sum of (2 x - n) (2 y - m) over the counts x of p and y of q, with their units n and m."""
        n, m = F.col(f"{p}.units").cast("double"), F.col(f"{q}.units").cast("double")
        both = total(F.zip_with(f"{p}.c", f"{q}.c", lambda i, j: low(i) * low(j) + high(i) * high(j)))
        x, y = (total(F.transform(f"{z}.c", lambda v: low(v) + high(v))) for z in (p, q))
        return 4 * both - 2 * m * x - 2 * n * y + 2 * PAIRS * n * m

    norms = product(a, a) + product(b, b)
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(2 * product(a, b), norms))), F.lit(1.0))


#: A bucket of more rows than this holds repeated ids, and is split by ranges of (id, text).
HOT = 1 << 10
#: Rows that a range is meant to hold, most ranges, and the code points of a text that tell ranges apart.
RANGE_ROWS, MOST_RANGES, PREFIX = 1 << 10, 1 << 14, 64
#: Hot buckets are broadcast up to this number, and joined by their rows' shuffle beyond it.
MAX_BROADCAST = 100_000
#: Result rows of equal documents are repeated in blocks of this many.
BLOCK = 1 << 12
#: Consecutive ids are ordered within buckets of this many, and buckets within buckets of so many again.
IDS, BUCKETS, LEVELS = 1 << 8, 1 << 16, 3


def following(keys: DataFrame) -> DataFrame:
    """(key, next): the next larger key of a table of distinct longs, null for the last, without one task that holds all.

    Keys are ordered within their bucket; the last of a bucket is followed by
    the first of the next bucket that there is, found the same way one level up.
    """

    def level(table: DataFrame, above: int) -> DataFrame:
        if not above:
            return table.select("key", F.lead("key").over(Window.orderBy("key")).alias("next"))
        inside = table.withColumn("b", F.shiftright("key", BUCKETS.bit_length() - 1))
        inside = inside.withColumn("next", F.lead("key").over(Window.partitionBy("b").orderBy("key")))
        firsts = inside.groupBy("b").agg(F.min("key").alias("first"))
        upper = level(firsts.select(F.col("b").alias("key")), above - 1)
        jump = upper.join(firsts, F.col("next") == F.col("b")).select(F.col("key").alias("b"), "first")
        return inside.join(jump, "b", "left").select("key", F.coalesce("next", "first").alias("next"))

    return level(keys, LEVELS)


#: What a row carries through the sums, as longs only, which Spark adds up fastest: its id, size and the parts of a SHA-256.
ABOUT = ["at", "n_chars", "d0", "d1", "d2", "d3"]
#: Stands for a null id, before all others.
NO_ID = -(1 << 63)


def edited_text() -> Column:
    """text without its last quarter (of code points, rounded down), then as many first ones of next_text."""
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))


def compared(vectors: DataFrame, keys: list[str], within: list[str], kind: str, also: Sequence[str] = ()) -> DataFrame:
    """Result rows from the vectors of a text, its edited text and the next text, which follow one another.

    Within rows of equal `within`, ordered by keys and kind, vectors of kind
    0 are results if two more follow: their edited text's and the next text's.
    """
    order = Window.partitionBy(*within).orderBy(*keys, kind)
    v = vectors.select(*keys, *within, kind, *ABOUT, *also, vector().alias("x"))
    v = v.withColumns({"e": F.lead("x", 1).over(order), "y": F.lead("x", 2).over(order)}).where((F.col(kind) == 0) & F.col("y").isNotNull())
    digest = F.lower(F.concat(*(F.lpad(F.hex(f"d{i}"), 16, "0") for i in range(4))))
    return v.select("at", "n_chars", *also, digest.alias("edited_sha256"), as_text("x").alias("fingerprint"), as_text("e").alias("edited_fingerprint"),
                    likeness("x", "e").alias("near_edited"), likeness("x", "y").alias("near_next"))


def split(rows: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows b, s, at, text, copies; the (b, s) that there are) where buckets of more than HOT rows are split by s.

    Equal rows are counted, by map-side sums, before they meet; what is left of the
    hot buckets is dealt by ranges of (id, first PREFIX code points of the text), so that
    s follows the order of the rows.  The ranges are fixed by writing them.
    """
    hot = sizes.where(F.col("n") > HOT).select("b")
    if hot.count() <= MAX_BROADCAST:
        hot = F.broadcast(hot)
    alike = cut_lineage(rows.join(hot, "b").groupBy("b", "at", "text").agg(F.count("*").alias("copies")))
    ranges = min(MOST_RANGES, 1 + alike.count() // RANGE_ROWS)
    dealt = cut_lineage(alike.repartitionByRange(ranges, "b", "at", F.substring("text", 1, PREFIX)).withColumn("s", F.spark_partition_id()))
    whole = rows.join(hot, "b", "left_anti").select("b", F.lit(0).alias("s"), "at", "text", F.lit(1).cast("long").alias("copies"))
    groups = sizes.where(F.col("n") <= HOT).select("b", F.lit(0).alias("s")).unionByName(dealt.select("b", "s").distinct())
    return whole.unionByName(dealt.select("b", "s", "at", "text", "copies")), groups


def next_groups(groups: DataFrame, start: int | None) -> DataFrame:
    """(b, s, next_b, next_s): the group after each; after the last one the first.  A bucket has MOST_RANGES groups at most."""
    firsts = groups.groupBy("b").agg(F.min("s").alias("first"))
    links = following(firsts.select(F.col("b").alias("key"))).select(F.col("key").alias("b"), F.coalesce("next", F.lit(start).cast("long")).alias("after"))
    links = links.join(firsts.select(F.col("b").alias("after"), "first"), "after")
    inside = groups.withColumn("within", F.lead("s").over(Window.partitionBy("b").orderBy("s")))
    return inside.join(links, "b").select("b", "s", F.when(F.col("within").isNull(), F.col("after")).otherwise(F.col("b")).alias("next_b"), F.coalesce("within", "first").alias("next_s"))


def repeated(df: DataFrame, times: str, by: list[str]) -> DataFrame:
    """Each row as many times as its column `times` says, which is dropped; blocks of BLOCK go to tasks of their own."""
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / BLOCK))
    dealt = df.withColumn("block", F.explode(blocks)).repartition(*by, "block")
    own = F.least(F.lit(BLOCK).cast("long"), F.col(times) - F.col("block") * BLOCK)
    return dealt.withColumn("each", F.explode(F.sequence(F.lit(1).cast("long"), own))).drop("each", "block", times)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text without its last floor(n_chars / 4) code
    points, then as many (or all) first ones of the next document: the next
    row by doc_id, then text, and after the last one the first.  Fingerprints do
    not depend on the order of paragraphs; likeness is estimated from the
    fingerprints alone.  Null texts count as empty; rows without id come
    before all others; repeated rows are kept, each the other's next; a single
    row is its own next; an empty table gives an empty result; other columns
    are not read.

    Texts are shuffled once, to buckets of IDS consecutive ids.  A bucket's rows
    are ordered, hashed, summed up and compared in place; only the last row
    of each bucket meets the next bucket's first by a join.  Ids are meant to
    be distinct; where a bucket holds more than HOT rows all the same (rows of
    one id, rows without id), it is split by ranges and its equal rows are
    looked at once.  Different texts of one id share a range if they share
    their first PREFIX code points.
    """
    at = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    bucket = F.shiftright(at, IDS.bit_length() - 1)
    rows = docs.select(bucket.alias("b"), at.alias("at"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = docs.select(bucket.alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    start, most = sizes.agg(F.min("b"), F.max("n")).first()
    by, hot = ["b"], (most or 0) > HOT
    if hot:
        by = ["b", "s"]
        rows, groups = split(rows, sizes)
        links = next_groups(groups, start)
    else:
        links = following(sizes.select(F.col("b").alias("key"))).select(F.col("key").alias("b"), F.coalesce("next", F.lit(start).cast("long")).alias("next_b"))
    order = Window.partitionBy(*by).orderBy("at", "text")
    rows = rows.withColumns({"rn": F.row_number().over(order), "next_text": F.lead("text").over(order), "before": F.lag("at").over(order)})
    parts = {f"d{i}": F.conv(F.substring("digest", 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)}

    def about(df: DataFrame) -> DataFrame:
        return df.withColumn("edited", edited_text()).withColumns({"n_chars": F.length("text").cast("long"), "digest": F.sha2("edited", 256)}).withColumns(parts)

    def texts(df: DataFrame, keys: list[str], *columns: str, also: tuple[str, ...] = ()) -> DataFrame:
        kinds = F.array(*(F.struct(F.lit(i).cast("long").alias("kind"), F.col(c).alias("t")) for i, c in enumerate(columns)))
        out = about(df).select(*keys, *ABOUT, *also, F.explode(kinds).alias("k")).where("k.t is not null")
        return sums(out.select(*keys, *ABOUT, *also, "k.kind", "k.t"), [*keys, "kind"], "t", [*ABOUT, *also])

    numbered = rows.withColumn("rn", F.col("rn").cast("long"))
    out = compared(texts(numbered, [*by, "rn"], "text", "edited"), ["rn"], by, "kind")

    after = [f"next_{c}" for c in by]
    heads = rows.where("before is null").select(*(F.col(c).alias(f"next_{c}") for c in by), F.col("text").alias("next_text"))
    lasts = rows.where("next_text is null").select(*by, "at", "text").join(links, by).join(heads, after)
    out = out.unionByName(compared(texts(lasts, by, "text", "edited", "next_text"), [], by, "kind"))
    if hot:  # all but the last of equal rows have an equal one as their next
        equal = numbered.where("copies > 1").withColumns({"next_text": F.col("text"), "times": F.col("copies") - 1})
        vectors = texts(equal, [*by, "rn"], "text", "edited", "next_text", also=("times",))
        out = out.unionByName(repeated(compared(vectors, ["rn"], by, "kind", also=["times"]), "times", ["at", "edited_sha256"]))
    doc_id = F.when(F.col("at") != NO_ID, F.col("at")).cast(docs.schema[id_col].dataType).alias("doc_id")
    return out.select(doc_id, *(c for c in out.columns if c != "at"))
