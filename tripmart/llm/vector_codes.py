"""Vector compression to codebook indexes, with equal-average nearest-entry search."""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripmart.llm.graph import cut_lineage

#: Parts of a vector, entries of a codebook (two hex digits allow 256), rounds of improvement, and the scale of integer components.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors searched together.
SLICE = 2048
#: Doubles hold integers below this exactly; vectors with larger squared distances are searched in Python integers.
EXACT = 2 ** 53
#: Sums travel as digits of this base, one for all but huge components.
BASE = 10 ** 30


@dataclass(frozen=True)
class Codebooks:
    """entries[part][index] is a tuple of integer components; all parts have the same number of entries."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]

    @property
    def parts(self) -> int:
        return len(self.entries)

    @property
    def width(self) -> int:
        return len(self.entries[0][0])

    @cached_property
    def by_sum(self) -> list[list[tuple[int, int]]]:
        """(component sum, index) of each part's entries, ascending."""
        return [sorted((sum(e), i) for i, e in enumerate(book)) for book in self.entries]

    @cached_property
    def largest(self) -> int:
        return max(abs(c) for book in self.entries for e in book for c in e)

    @cached_property
    def sha256(self) -> str:
        """Digest of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(str(c) for book in self.entries for e in book for c in e).encode()).hexdigest()


class Search:
    """Nearest entries of many vectors at once.

    Each part starts at the entry whose component sum is nearest to its own
    and goes on to smaller and to larger sums.  By Cauchy-Schwarz, the squared
    gap of the sums is at most the width times the squared distance, so a
    direction ends once the gap strictly exceeds the best distance so far.
    """

    def __init__(self, books: Codebooks):
        self.books, width = books, books.width
        count = len(books.entries[0])
        # Sorted by sums, with an end on either side that no gap reaches.
        self.stride = count + 2
        self.sums = np.full((books.parts, self.stride), np.inf)
        self.sums[:, 0] = -np.inf
        self.index = np.zeros((books.parts, self.stride), np.int64)
        self.points = np.zeros((books.parts, self.stride, width))
        self.exact = 4 * books.parts * width * books.largest ** 2 < EXACT
        if self.exact:
            for p, order in enumerate(books.by_sum):
                self.sums[p, 1:-1] = [s for s, _ in order]
                self.index[p, 1:-1] = [i for _, i in order]
                self.points[p, 1:-1] = [books.entries[p][i] for _, i in order]
        self.flat_sums, self.flat_index, self.flat_points = self.sums.ravel(), self.index.ravel(), self.points.reshape(-1, width)

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes, squared distances), each (n, parts), of vectors (n, parts * width) of integers in doubles or Python integers."""
        books, width = self.books, self.books.width
        parts = vectors.reshape(len(vectors), books.parts, width)
        top = max(books.largest, int(abs(vectors).max(initial=0)))
        if vectors.dtype == object or not self.exact or 4 * books.parts * width * top ** 2 >= EXACT:
            found = [[self.one([int(c) for c in part], p) for p, part in enumerate(v)] for v in parts]
            out = np.array(found, object).reshape(len(vectors), books.parts, 2)
            return out[:, :, 0].astype(np.int64), out[:, :, 1]
        sums = parts.sum(2)
        first = np.empty(sums.shape, np.int64)
        for p in range(books.parts):  # the ends stay out, so that every part starts from an entry
            first[:, p] = np.clip(np.searchsorted(self.sums[p], sums[:, p]), 1, self.stride - 2) + p * self.stride
        x, s, first = parts.reshape(-1, width), sums.ravel(), first.ravel()
        best = ((x - self.flat_points[first]) ** 2).sum(1)
        index = self.flat_index[first]
        for step in (1, -1):
            at, active = first, np.arange(len(x))
            while len(active):
                at = at + step
                gap = self.flat_sums[at] - s[active]
                near = np.flatnonzero(gap * gap <= width * best[active])
                at, active = at[near], active[near]
                difference = x[active] - self.flat_points[at]
                d, i = np.einsum("ij,ij->i", difference, difference), self.flat_index[at]
                better = (d < best[active]) | ((d == best[active]) & (i < index[active]))
                best[active[better]], index[active[better]] = d[better], i[better]
        return index.reshape(sums.shape), best.reshape(sums.shape)

    def one(self, part: list[int], p: int) -> tuple[int, int]:
        """(index, squared distance) of one part, in Python integers of any size."""
        order, book, own = self.books.by_sum[p], self.books.entries[p], sum(part)
        middle = bisect_left(order, (own, -1))
        best: tuple[int, int] | None = None
        for side in (order[middle:], order[:middle][::-1]):
            for s, i in side:
                if best and (s - own) ** 2 > len(part) * best[0]:
                    break
                d = sum((a - b) ** 2 for a, b in zip(part, book[i], strict=True))
                best = min(best, (d, i)) if best else (d, i)
        return best[1], best[0]


def integers(values: pa.Array, dimension: int) -> np.ndarray:
    """Vectors (n, dimension) of floor(SCALE * component), in doubles where these hold them exactly, else in Python integers."""
    x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    if np.abs(x).max(initial=0.0) < EXACT / SCALE:
        return np.floor(x * SCALE)
    return np.array([[int(c) * SCALE if abs(c) >= EXACT else math.floor(c * SCALE) for c in v] for v in x.tolist()], object)


def usable(vector: str) -> Column:
    """Whether a vector is there and has no null or non-finite component."""
    v = F.col(vector)
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def kept_vectors(df: DataFrame, parts: int, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """(vec_id, vector, label) of usable vectors that can be cut into equal parts."""
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    kept = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), label.alias("label")).where(usable("vector"))
    return kept.where((F.size("vector") > 0) & (F.size("vector") % parts == 0))


def first_books(kept: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; vectors of one id go by their components, a null id comes last."""
    order = [F.asc_nulls_last("vec_id"), "vector"]
    rows = kept.orderBy(*order).limit(entries).select("vector").collect()
    if not rows:
        return None
    dimension = len(rows[0]["vector"])
    if any(len(r["vector"]) != dimension for r in rows):
        rows = kept.where(F.size("vector") == dimension).orderBy(*order).limit(entries).select("vector").collect()
    seeds = integers(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), dimension).reshape(len(rows), parts, -1)
    return Codebooks(tuple(tuple(tuple(int(c) for c in seeds[e, p]) for e in range(len(rows))) for p in range(parts)))


def digits(n: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of the digits of n that are not 0, with the sign of n."""
    sign, n, place = (-1 if n < 0 else 1), abs(n), 0
    while n:
        n, digit = divmod(n, BASE)
        if digit:
            yield place, sign * digit
        place += 1


def improved(kept: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks whose entries are the floored means of the parts nearest to them; an entry without parts stays.

    Each task adds its parts up; what comes to the driver is one number for
    each component of the codebooks.
    """
    count, width = len(books.entries[0]), books.width
    cells, dimension = books.parts * count, books.parts * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, total = Search(books), np.zeros((cells, width + 1), object)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                vectors = integers(batch.column(0).slice(at, SLICE), dimension)
                cell = (search(vectors)[0] + np.arange(books.parts) * count).ravel()
                values = vectors.reshape(-1, width)
                if vectors.dtype == object or np.abs(values).max(initial=0) * len(cell) >= EXACT:
                    np.add.at(total, cell, np.hstack([np.array([[int(c) for c in v] for v in values], object), np.ones((len(cell), 1), object)]))
                else:
                    added = np.stack([np.bincount(cell, w, cells) for w in (*values.T, np.ones(len(cell)))], 1)
                    total += added.astype(np.int64).astype(object)
        rows = [(cell, digit, Decimal(n)) for cell, t in enumerate(total.ravel()) for digit, n in digits(int(t))]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.decimal128(38, 0))], names=["cell", "digit", "total"])

    found: dict[int, int] = {}
    sums = kept.select("vector").mapInArrow(run, "cell int, digit int, total decimal(38,0)").groupBy("cell", "digit").agg(F.sum("total").alias("total"))
    for r in sums.collect():
        found[r["cell"]] = found.get(r["cell"], 0) + int(r["total"]) * BASE ** r["digit"]

    def entry(p: int, i: int) -> tuple[int, ...]:
        *total, n = (found.get((p * count + i) * (width + 1) + k, 0) for k in range(width + 1))
        return tuple(t // n for t in total) if n else books.entries[p][i]

    return Codebooks(tuple(tuple(entry(p, i) for i in range(count)) for p in range(books.parts)))


def train(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding") -> Codebooks | None:
    """Codebooks learned from all usable vectors of the dimension of the one with the smallest id; None if there is none."""
    kept = kept_vectors(df, parts, id_col, vector_col)
    books = first_books(kept, parts, entries)
    for _ in range(rounds if books else 0):
        books = improved(kept.where(F.size("vector") == books.parts * books.width), books)
    return books


def encode(df: DataFrame, books: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, code, error) of every usable vector of the codebooks' dimension: two hex digits a part, and the squared distance.

    An error beyond 64 bits is null.
    """
    dimension = books.parts * books.width
    kept = kept_vectors(df, books.parts, id_col, vector_col, label_col).where(F.size("vector") == dimension).select("vec_id", "label", "vector")
    schema = StructType(kept.schema.fields[:2] + StructType.fromDDL("code string, error long").fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(books)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                index, distance = search(integers(batch.column(2), dimension))
                codes = [row.tobytes().hex() for row in index.astype(np.uint8)]
                errors = [e if (e := int(d)) < 2 ** 63 else None for d in distance.sum(1)]
                made = [pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).cast(arrow.field(i).type) for i in range(2)), *made], schema=arrow)

    return kept.mapInArrow(run, schema)


def decode(codes: DataFrame, books: Codebooks, code_col: str = "code") -> DataFrame:
    """codes with a column `vector`: the entries that the code names, scaled back."""
    flat = F.array(*(F.array(*(F.array(*(F.lit(c / SCALE) for c in e)) for e in book)) for book in books.entries))
    part = F.sequence(F.lit(0), F.lit(books.parts - 1))
    index = lambda p: F.conv(F.substring(F.col(code_col), p * 2 + 1, F.lit(2)), 16, 10).cast("int")
    return codes.withColumn("vector", F.flatten(F.transform(part, lambda p: F.get(F.get(flat, p), index(p)))))


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error (long), codebooks_sha256.

    A vector is not usable if it is null, holds a null or non-finite
    component, can't be cut into equal parts, or has another length than the
    first (the one with the smallest id).  label_error adds up the errors of
    equal labels, nulls together; no usable vector gives an empty result;
    repeated rows are kept; other columns are not read.  A common label is
    added up before the shuffle, and its sum is joined back by key.
    """
    books = train(df, parts, entries, rounds, id_col, vector_col)
    if books is None:
        none = kept_vectors(df, parts, id_col, vector_col).limit(0)
        return none.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = cut_lineage(encode(df, books, id_col, vector_col, label_col))
    labels = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("same")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
