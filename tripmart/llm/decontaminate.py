"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.graph import cut_lineage
from tripmart.llm.text import per_text

#: A word is a run of characters other than controls, blanks and ASCII punctuation, after lower-casing.
WORD = re.compile(r"[^\x00-\x20!-/:-@\[-`{-\x7f]+")
#: Items searched for at once: each block has at most about so many items and characters, and takes one pass over the documents.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 16_000_000
#: Windows of a document hashed at once, so that a very long text needs no more memory than this.
BLOCK_WORDS = 1 << 18


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer: the order of its values is the permutation that MinHash takes minima by."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each window of width word ids; 0 if a window has a word without id (0)."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(width):
        part = ids[i:i + n]
        h = mixed(h + part * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        known &= part != 0
    return np.where(known, h | np.uint64(1 << 63), np.uint64(0))


class Search:
    """Items of one block, searched for in documents.

    Items with fewer words than a shingle have one shingle of all of them,
    so items are grouped by the width of their shingles.  Within a width,
    items fall into size partitions (powers of two of their number of distinct
    shingles).  A partition up to size u keeps each item's floor((1 - t) * u)
    + 1 smallest MinHash values: a document that contains a share t of the
    item's shingles holds at least one of these, so probing a document's
    shingles against the sketches loses no item.  Sketching the long side too
    would lose some: the Jaccard similarity of an item with a long document
    goes to zero.  Candidates are verified by counting shared shingles.
    """

    def __init__(self, items: Iterable[tuple[object, str | None]], threshold: float, width: int):
        self.threshold, self.ids, self.vocabulary, self.widths = threshold, [], {}, {}
        by_width: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in items:
            found = words(text)
            if found:
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found], np.uint64)
                k = min(width, len(found))
                by_width.setdefault(k, []).append((len(self.ids), np.unique(shingle_hashes(ids, k))))
                self.ids.append(item_id)
        self.shingles = {i: s for group in by_width.values() for i, s in group}
        for k, group in by_width.items():
            keys, owners = [], []
            for i, s in group:
                upper = 1 << (len(s) - 1).bit_length()  # of the item's size partition
                keep = min(len(s), int((1 - threshold) * upper + 1e-9) + 1)
                keys.append(s[np.argsort(mixed(s), kind="stable")[:keep]])
                owners.append(np.full(keep, i))
            keys, owners = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(keys, kind="stable")
            self.widths[k] = keys[order], owners[order]

    def found_in(self, text: str | None) -> list[tuple[int, int]]:
        """(item's position, shared shingles) of the items that the whole text contains."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words(text)], np.uint64)
        out = []
        for k, (keys, owners) in self.widths.items():
            have = [np.zeros(0, np.uint64)]
            for at in range(0, len(ids) - k + 1, BLOCK_WORDS):
                h = shingle_hashes(ids[at:at + BLOCK_WORDS + k - 1], k)
                have.append(np.unique(h[h != 0]))
            have = np.unique(np.concatenate(have))
            if not len(have):
                continue
            lo, hi = np.searchsorted(keys, have, "left"), np.searchsorted(keys, have, "right")
            candidates = {int(i) for a, b in zip(lo[hi > lo], hi[hi > lo], strict=True) for i in owners[a:b]}
            for i in sorted(candidates):
                shared = int(np.isin(self.shingles[i], have, assume_unique=True).sum())
                if shared >= self.threshold * len(self.shingles[i]) - 1e-9:
                    out.append((i, shared))
        return out


def searches(benchmark: DataFrame, threshold: float, width: int, item_col: str, text_col: str) -> Iterator[Search]:
    """The benchmark in blocks of bounded size, one on the driver at a time; equal rows are one item, whose id is (item_id, their number)."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).groupBy("item_id", "text").agg(F.count("*").alias("n"))
    items = cut_lineage(items)
    n, chars = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-(chars or 0) // BLOCK_CHARS))
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Search((((r.item_id, r.n), r.text) for r in mine.collect()), threshold, width)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, width: int = 5,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of docs and item that it contains: doc_id, item_id, n_shared, n_shingles, containment.

    Containment is the share of the item's distinct word shingles that occur
    in the whole document, at least threshold.  The benchmark is cut into
    blocks of bounded size, each searched for in one pass over docs without a
    shuffle, so that neither tasks nor the driver hold more than a block.
    Null and empty texts contain nothing and are contained nowhere; repeated
    rows of either side give repeated rows; other columns are not read.
    """
    kind = benchmark.schema[item_col].dataType.simpleString()
    found = []
    for search in searches(benchmark, threshold, width, item_col, item_text_col):

        def start(search: Search = search):
            def work(texts):
                index, item, shared, sizes, copies = [], [], [], [], []
                for at, t in enumerate(texts):
                    for i, k in search.found_in(t):
                        index.append(at)
                        item.append(search.ids[i][0])
                        copies.append(search.ids[i][1])
                        shared.append(k)
                        sizes.append(len(search.shingles[i]))
                return index, [item, shared, sizes, copies]

            return work

        found.append(per_text(docs, [(id_col, "doc_id")], text_col, f"item_id {kind}, n_shared long, n_shingles long, copies long", start))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = out.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, width: int = 5) -> DataFrame:
    """The rows of docs whose text contains no item of the benchmark, all columns, by the same search.

    Rows are judged one by one, so neither null nor repeated ids matter.
    """
    rest = [(c, c) for c in docs.columns if c != "text"]
    for search in searches(benchmark, threshold, width, "item_id", "text"):

        def start(search: Search = search):
            def work(texts):
                keep = [i for i, t in enumerate(texts) if not search.found_in(t)]
                return keep, [[texts[i] for i in keep]]

            return work

        docs = per_text(docs, rest, "text", "text string", start).select(*docs.columns)
    return docs
