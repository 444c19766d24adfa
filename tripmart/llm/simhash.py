"""SimHash near-duplicate groups with pivot distance tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from math import comb

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.graph import components, cut_lineage
from tripmart.llm.text import per_text

#: Shingles hashed per numpy block, so that a very long text needs no more memory than this.
BLOCK = 1 << 16


def fingerprint(text: str | None, words_per_shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a whole text: a bit is 1 if set in over half of the shingles' XXH64.

    Words are runs of non-blank bytes after lower-casing A-Z; a text with fewer
    words than a shingle has one shingle of all of them, and one without words
    (or null) has fingerprint 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist(), strict=True)
        h = np.array([digest(joined[s:e], seed) for s, e in spans], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def references(n: int) -> list[int]:
    """The n reference fingerprints (signed) that pivot tables measure against."""
    return [int(np.uint64(xxhash.xxh64_intdigest(f"reference {i}".encode())).view(np.int64)) for i in range(n)]


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, also: Sequence[str] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, also, fp): the signed 64-bit fingerprint of every whole text."""

    def start():
        return lambda texts: (None, [np.fromiter((fingerprint(t, words_per_shingle) for t in texts), np.uint64, len(texts)).view(np.int64)])

    return per_text(docs, [(id_col, "doc_id"), *((c, c) for c in also)], text_col, "fp long", start)


def near_links(fps: DataFrame, max_bits: int = 2, n_references: int = 24, group_limit: int = 256) -> DataFrame:
    """Links (a, b), enough to connect all distinct fingerprints (column fp) at most max_bits apart.

    The pivot table holds each fingerprint's Hamming distances to many
    reference fingerprints.  Two fingerprints max_bits apart agree on one of
    max_bits + 1 bit ranges, so pairs come from equal ranges; a pair whose
    largest coordinate difference exceeds max_bits is discarded, and the rest
    is verified by its exact distance.  Ranges shared by over group_limit
    fingerprints emit no pairs: there, each fingerprint names all values
    within half of max_bits, and fingerprints naming the same value are linked
    to the smallest of them, which finds the same components exactly at a
    cost linear in the group's size.
    """
    bits = lambda x: F.bit_count(x).cast("tinyint")
    edges = [round(i * 64 / (max_bits + 1)) for i in range(max_bits + 2)]
    ranges = [
        F.struct(F.lit(i).cast("tinyint").alias("range"), F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1)).alias("value"))
        for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))
    ]
    pivots = [bits(F.col("fp").bitwiseXOR(F.lit(p))).alias(f"p{i}") for i, p in enumerate(references(n_references))]
    banded = fps.select("fp", F.explode(F.array(*ranges)).alias("r")).select("fp", "r.range", "r.value")
    hot = banded.groupBy("range", "value").count().where(F.col("count") > group_limit).select("range", "value")
    table = banded.join(hot, ["range", "value"], "left_anti").select("range", "value", "fp", *pivots)
    x, y = table.alias("x"), table.alias("y")
    near = [F.abs(F.col(f"x.p{i}") - F.col(f"y.p{i}")) <= max_bits for i in range(n_references)]
    match = (F.col("x.range") == F.col("y.range")) & (F.col("x.value") == F.col("y.value")) & (F.col("x.fp") < F.col("y.fp"))
    for c in near:
        match &= c
    pairs = x.join(y, match & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits))
    pairs = pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))

    small, large = max_bits // 2, (max_bits + 1) // 2
    masks = [sum(1 << i for i in c) for n in range(large + 1) for c in combinations(range(64), n)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    n_small = sum(comb(64, n) for n in range(small + 1))
    crowded = banded.join(hot, ["range", "value"], "left_semi").select("fp").distinct()
    named = crowded.select("fp", F.posexplode(F.array(*map(F.lit, masks))).alias("i", "mask"))
    named = named.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("name"), F.when(F.col("i") < n_small, F.col("fp")).alias("centre"))
    centres = named.groupBy("name").agg(F.min("centre").alias("a"), F.count("*").alias("n")).where("a is not null and n > 1")
    stars = named.join(centres, "name").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    return pairs.unionByName(stars).distinct()


def grouped(docs: DataFrame, words_per_shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, k1, k2, fp, root, component_id) of each row: k1 and k2 hash its id and text, root names its group."""
    keys = {"k1": F.xxhash64(id_col, text_col), "k2": F.hash(text_col, id_col)}
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *(x.alias(k) for k, x in keys.items()))
    prints = cut_lineage(fingerprints(keyed, words_per_shingle, ["k1", "k2"]))
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = components(near_links(distinct, max_bits)).withColumnRenamed("node", "fp")
    linked = distinct.join(roots, "fp", "left").withColumn("linked", F.col("root").isNotNull()).withColumn("root", F.coalesce("root", "fp"))
    # Only groups of several rows are joined back: the others are their own.
    several = linked.where("linked or n > 1").select("fp", "root", "first")
    smallest = several.groupBy("root").agg(F.min("first").alias("component_id"))
    members = several.join(smallest, "root").select("fp", "root", "component_id")
    out = prints.join(members, "fp", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "k1", "k2", "fp", F.coalesce("root", "fp").alias("root"), component.alias("component_id"))


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp (signed long), component_id.

    Fingerprints at most max_bits apart link; component_id is the smallest
    doc_id reachable, itself included.  Null, empty and blank texts have
    fingerprint 0, linked like any other.  Rows without an id take part and
    get the smallest id of their group, or null if no row of it has one.
    Repeated rows are kept, an empty table gives an empty result, and other
    columns are not read.
    """
    return grouped(docs, words_per_shingle, max_bits, id_col, text_col).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs of each near-duplicate group, all columns: the one of the smallest id.

    Of several rows with that id, the one whose id and text hash least; of
    equal ones, any one.  Rows without id come after all others.
    """
    groups = grouped(docs, words_per_shingle, max_bits, id_col, text_col)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("r"))
    first = first.select(F.col("r.k1").alias("_k1"), F.col("r.k2").alias("_k2"))
    keyed = docs.withColumns({"_k1": F.xxhash64(id_col, text_col), "_k2": F.hash(text_col, id_col)})
    return keyed.join(first, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select(*docs.columns)
