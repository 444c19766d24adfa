"""Language-model scores: corpus word counts, and an attention model over subword classes trained on the whole corpus."""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripmart.llm import attention
from tripmart.llm.attention import CLASSES, WINDOW, Adam, Scorer, Weights, keep_memory
from tripmart.llm.graph import cut_lineage, shared_folder
from tripmart.llm.token_counts import encoder

#: Ranks of a byte-level BPE vocabulary for many languages.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Stands for the end of a text among words, which have no blanks.
END = " "
#: At most about so many of the most frequent words have their counts with every task; the others are joined by word.
FREQUENT = 200_000
#: Words kept with their subwords in a task.
CACHE = 400_000
#: Texts that start within so many bytes are encoded together, each of their words once.
CHUNK = 1 << 21
#: Stored chunks are rows of some megabytes: sizes are looked at from the first row on, so that few are held together.
LARGE_ROWS = {"compression": "zstd", "parquet.block.size": 1 << 24, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
#: Rounds of training: the windows of a text are dealt over them, and each ends with the mean of all shards' weights.
ROUNDS = 8
#: Windows of a shard, which goes through its part of a round alone; windows of a step; and the first round's step width.
WINDOWS_PER_SHARD, BATCH, RATE = 262_144, 256, 0.04
#: Weight vectors added up by one task when averaging.
FAN_IN = 32
LN10 = float(np.log(10))
SUM_FIELDS = "sum binary, n long"
#: A text's windows of one round; or, with round -1, a chunk: its words joined by blanks, their counts in the texts learned from, their token ids
#: and how many each has, the place of each word of all texts among these words, and how many words each text has.
STORED = "h long, windows binary, n long, hs array<long>, words string, learned binary, ids binary, spans binary, places binary, lengths binary, round int"


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a whole text, between blanks."""
    return (text or "").encode().lower().split()


def held_out(id_col: str) -> Column:
    """Whether a row is never learned from: crc32 of its id as text leaves 2 modulo 7.  Rows without id are learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(texts: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(word, n) over texts (columns text, h), ends of texts included."""
    return stored_counts(stored(texts, vocabulary))


def stored_counts(table: DataFrame) -> DataFrame:
    """(word, n) over the texts learned from, ends of texts included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, learned, ends in zip(*batch.columns, strict=True):
                n = unpacked(learned)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([split_at(word).take(pa.array(some)), pa.array(n[some])], names=["word", "n"])
                if ends.as_py():
                    yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends.as_py()], pa.int64())], names=["word", "n"])

    return chunks(table, "words", "learned", "n").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def least_frequent(counts: DataFrame) -> int:
    """The least count of frequent words, of which there are FREQUENT at most unless many share one count."""
    level = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.min("n").alias("least")).orderBy(F.desc("level")).collect():
        total += r["words"]
        if total > FREQUENT:
            break
        least = r["least"]
    return least if least is not None else (1 << 62)


@lru_cache(maxsize=4)
def after_blank(vocabulary: str) -> np.ndarray:
    """Whether each token starts with a blank."""
    encoding = encoder(vocabulary)[0]
    out = np.zeros(encoder(vocabulary)[1].size + 1, bool)
    for token in encoding.token_byte_values():
        if token[:1] == b" ":
            out[encoding.encode_single_token(token)] = True
    return out


def encoded(fresh: str, n: int, vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of n words that blanks join, each after a blank, and the place where each word's ids start.

    Words are encoded together: each one's tokens start with the one that has the blank before it.
    """
    encoding = encoder(vocabulary)[0]
    ids = encoding.encode_to_numpy(" " + fresh) if n else np.zeros(0, np.uint32)
    starts = np.flatnonzero(after_blank(vocabulary)[ids])
    if len(starts) != n:  # other white space than words end at can join pieces
        each = [encoding.encode_ordinary(" " + w) for w in fresh.split(" ")]
        starts = np.cumsum([0, *map(len, each[:-1])])
        ids = np.array([i for one in each for i in one], np.uint32)
    return ids, starts


@dataclass
class Chunk:
    """Texts whose words are told apart: places of all words of all texts, how many each text has, and the words' token ids, so many each."""

    places: np.ndarray
    lengths: np.ndarray
    ids: np.ndarray
    spans: np.ndarray

    def spelled(self, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of all texts one after the other, the id end closing each; how many each text has; the place of each of its words, the
        end's after all others; and how many tokens each of these has."""
        owner_ends = np.cumsum(self.lengths)
        places = np.insert(self.places, owner_ends, len(self.spans))
        ids, spans = np.append(self.ids, self.ids.dtype.type(end)), np.append(self.spans, 1)
        sizes = spans[places]
        ends = np.cumsum(sizes)
        at = np.repeat((np.cumsum(spans) - spans)[places] - ends + sizes, sizes)
        at += np.arange(len(at))
        last = ends[owner_ends + np.arange(len(self.lengths))] if len(self.lengths) else ends
        return ids[at], np.diff(last, prepend=0), places, sizes


def packed(numbers: np.ndarray) -> pa.Array:
    """Numbers from 0 on in as few bytes as the largest needs, as one binary value: all lowest bytes first, as these compress apart."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return pa.array([kind.char.encode() + numbers.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()], pa.binary())


def unpacked(value: pa.Scalar) -> np.ndarray:
    raw = np.frombuffer(value.as_buffer(), np.uint8)
    kind = np.dtype(chr(raw[0]))
    return np.ascontiguousarray(raw[1:].reshape(kind.itemsize, -1).T).view(kind).reshape(-1).astype(np.int64)


def told_apart(texts: pa.Array, vocabulary: str) -> tuple[Chunk, pa.Array]:
    """The chunk of whole texts, and its lower-cased (A-Z) words, which stand between blanks.  Null texts are empty."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, offsets = found.flatten(), found.offsets.to_numpy()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)])
    each = flat.filter(real).dictionary_encode()
    ids, starts = encoded(pc.binary_join(pa.ListArray.from_arrays([0, len(each.dictionary)], each.dictionary), " ")[0].as_py(), len(each.dictionary), vocabulary)
    return Chunk(each.indices.to_numpy().astype(np.int64), np.diff(before[offsets]), ids.astype(np.int64), np.diff(starts, append=len(ids))), each.dictionary


def split_at(words: pa.Scalar) -> pa.Array:
    """Words that blanks join."""
    if not words.as_buffer().size:
        return pa.array([], pa.string())
    return pc.split_pattern(pa.array([words.as_py()], pa.string()), " ").flatten()


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Slices (first, number) of texts that start within the same CHUNK bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // CHUNK
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).tolist()
    return ((a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def token_type(vocabulary: str) -> np.dtype:
    """Holds every token id, the one that ends texts and the one beyond that stands for no token."""
    return np.min_scalar_type(encoder(vocabulary)[1].size + 2)


def chunks(table: DataFrame, *columns: str) -> DataFrame:
    return table.where("round = -1").select(*columns)


def stored(texts: DataFrame, vocabulary: str, rounds: int = ROUNDS) -> DataFrame:
    """Texts (columns text, h: a hash of the row; doc_id and learn: whether to learn from it, if there) in the shared folder, each word
    of a chunk encoded once: chunks of all texts, and the windows of those to learn from, dealt over the rounds."""
    spark = texts.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/windows-{uuid.uuid4().hex}"
    doc_id = F.col("doc_id") if "doc_id" in texts.columns else F.col("h")
    learn = F.col("learn") if "learn" in texts.columns else F.lit(True)
    texts = texts.select(doc_id.alias("doc_id"), "h", learn.alias("learn"), "text")
    fields = f"doc_ids array<{texts.schema['doc_id'].dataType.simpleString()}>, {STORED}"
    arrow = to_arrow_schema(StructType.fromDDL(fields))
    kind = token_type(vocabulary)

    def rows(**columns: pa.Array) -> pa.RecordBatch:
        gone = pa.nulls(len(columns["round"]))
        return pa.RecordBatch.from_arrays([columns.get(f.name, gone).cast(f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        end = encoder(vocabulary)[1].size
        for whole in batches:
            for at, n in pieces(whole.column(3)):
                doc_ids, h, learn, texts = whole.slice(at, n).columns
                chunk, found = told_apart(texts, vocabulary)
                tokens, sizes, _, _ = chunk.spelled(end)
                learn = learn.to_numpy(zero_copy_only=False)
                windows, counts = windows_of(tokens[np.repeat(learn, sizes)].astype(kind), sizes[learn], end, end + 1)
                h_own = h.to_numpy()[learn]
                # Windows of a text and round are one row.
                owner = np.repeat(np.arange(len(counts)), counts)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                key = owner * rounds + (h_own[owner] % rounds + nth) % rounds
                order = np.argsort(key, kind="stable")
                cuts = np.flatnonzero(np.diff(key[order], prepend=-1))
                key, number = key[order[cuts]], np.diff(np.append(cuts, len(order)))
                yield rows(
                    round=pa.array(key % rounds), h=pa.array(h_own[key // rounds]), n=pa.array(number),
                    windows=binaries(windows[order], np.append(cuts, len(order))),
                )
                learned = np.bincount(chunk.places[np.repeat(learn, chunk.lengths)], minlength=len(found)).astype(np.int64)
                parts = {"learned": learned, "ids": chunk.ids, "spans": chunk.spans, "places": chunk.places, "lengths": chunk.lengths}
                yield rows(
                    round=pa.array([-1]), n=pa.array([int(learn.sum())]), doc_ids=pa.ListArray.from_arrays([0, n], doc_ids), hs=pa.ListArray.from_arrays([0, n], h),
                    words=pc.binary_join(pa.ListArray.from_arrays([0, len(found)], found), " "), **{k: packed(x) for k, x in parts.items()},
                )

    texts.mapInArrow(run, fields).write.partitionBy("round").options(**LARGE_ROWS).parquet(folder)
    return spark.read.schema(fields).parquet(folder)


def binaries(rows: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary value for the rows between each two cuts."""
    rows = np.ascontiguousarray(rows)
    offsets = (cuts * (rows.itemsize * rows.shape[1])).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


class Places(dict):
    """Place of each word met so far; a new word gets the next place and is noted in fresh."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        self.fresh.append(word)
        return place


class Subwords:
    """Token ids of words, encoded one by one after a blank, kept for the words met last."""

    def __init__(self, vocabulary: str, known: dict[bytes, int] | None = None):
        self.vocabulary = vocabulary
        self.size = encoder(vocabulary)[1].size + 1  # the last id ends texts
        self.known = known or {}
        self.reset()

    def reset(self) -> None:
        # Arrays that grow in place; numpy looks into them without copying, one call at a time.
        self.at = Places()
        self.ids, self.starts, self.counts = array("q"), array("q", [0]), array("q")

    def _add(self, fresh: list[bytes]) -> None:
        """Keep the tokens and counts of words that are new."""
        ids, starts = encoded(b" ".join(fresh).decode(), len(fresh), self.vocabulary)
        self.starts.frombytes((np.append(starts[1:], len(ids)) + len(self.ids)).tobytes())
        self.ids.frombytes(ids.astype(np.int64).tobytes())
        get = self.known.get
        self.counts.extend([get(w, -1) for w in fresh])

    def places(self, text: list[bytes]) -> np.ndarray:
        """Place of each word among those kept."""
        if len(self.at) > CACHE:
            self.reset()
        out = np.fromiter(map(self.at.__getitem__, text), np.int64, len(text))
        if self.at.fresh:
            self._add(self.at.fresh)
            self.at.fresh = []
        return out

    def tokens(self, places: np.ndarray) -> np.ndarray:
        """Token ids of words at places, and last the id that ends a text."""
        out = np.array([self.size - 1])
        if len(places):
            starts = np.frombuffer(self.starts, np.int64)
            first = starts[places]
            sizes = starts[places + 1] - first
            ends = np.cumsum(sizes)
            ids = np.frombuffer(self.ids, np.int64)[np.arange(ends[-1]) + np.repeat(first - ends + sizes, sizes)]
            out = np.concatenate([ids, out])
        return out

    def sizes(self, places: np.ndarray) -> np.ndarray:
        """Number of tokens of words at places."""
        starts = np.frombuffer(self.starts, np.int64)
        return starts[places + 1] - starts[places] if len(places) else np.zeros(0, np.int64)

    def known_counts(self, places: np.ndarray) -> np.ndarray:
        """Corpus counts of words at places; -1 if a word is not frequent."""
        return np.frombuffer(self.counts, np.int64)[places] if len(places) else np.zeros(0, np.int64)


def subword_counts(counts: DataFrame, vocabulary: str) -> np.ndarray:
    """How often each token occurs in the corpus, from its words' counts; the vocabulary bounds what comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(encoder(vocabulary)[1].size + 1, np.int64)
        for batch in batches:
            found = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            n[-1] += found.pop(END, 0)
            ids, starts = encoded(" ".join(found), len(found), vocabulary)
            np.add.at(n, ids, np.repeat(np.fromiter(found.values(), np.int64, len(found)), np.diff(np.append(starts, len(ids)))))
        ids = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n[ids], pa.int64())], names=["id", "n"])

    out = np.zeros(encoder(vocabulary)[1].size + 1, np.int64)
    for r in counts.select("word", "n").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def stored_subwords(table: DataFrame, vocabulary: str) -> np.ndarray:
    """How often each token, and last the end, occurs in the texts learned from; the vocabulary bounds what comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(encoder(vocabulary)[1].size + 1, np.int64)
        for batch in batches:
            for ids, spans, learned, ends in zip(*batch.columns, strict=True):
                np.add.at(n, unpacked(ids), np.repeat(unpacked(learned), unpacked(spans)))
                n[-1] += ends.as_py()
        ids = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n[ids], pa.int64())], names=["id", "n"])

    out = np.zeros(encoder(vocabulary)[1].size + 1, np.int64)
    for r in chunks(table, "ids", "spans", "learned", "n").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


class Classes:
    """Classes of tokens: the most frequent tokens have one each, the others share the last ones by frequency.

    The probability of a token is its class's, by the attention model, times its share of the class.
    """

    SHARED = attention.MEMBERS

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        single = CLASSES - self.SHARED
        self.of = np.zeros(len(counts), np.int16)
        self.of[order[:single]] = np.arange(min(single, len(order)))
        rest = order[single:]
        mass = np.cumsum(counts[rest] + 1.0)
        if len(rest):
            self.of[rest] = single + np.minimum(self.SHARED - 1, (mass * self.SHARED / (mass[-1] + 1)).astype(np.int64))
        total = np.bincount(self.of, counts + 1.0, CLASSES)
        self.log_share = np.log((counts + 1.0) / total[self.of])
        self.counts = np.bincount(self.of, counts, CLASSES)
        self.end = int(self.of[-1])


def all_windows(texts: list[str | None], subwords: Subwords, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """(windows, number of each text's).  Consecutive windows of class ids over whole texts."""
    ids = [classes.of[subwords.tokens(subwords.places(words(t)))] for t in texts]
    return windows_of(np.concatenate([np.zeros(0, np.int16), *ids]), np.array([len(x) for x in ids], np.int64), classes.end, -1)


def windows_of(ids: np.ndarray, lengths: np.ndarray, begin: int, none: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows, number of each text's).  Consecutive windows (n, WINDOW + 1) of ids over whole texts, so many each, in which each token and end is a target once; none beyond a text's end.

    The last id of a window is the first of the text's next one, where it is context alone; begin comes before a text.
    """
    counts = -(-lengths // WINDOW)
    firsts = np.cumsum(counts) - counts
    rows = np.full((int(counts.sum()), WINDOW + 1), none, ids.dtype)
    targets = np.full(len(rows) * WINDOW, none, ids.dtype)
    targets[np.arange(len(ids)) + np.repeat(firsts * WINDOW - np.cumsum(lengths) + lengths, lengths)] = ids
    rows[:, 1:] = targets.reshape(-1, WINDOW)
    rows[1:, 0] = rows[:-1, -1]
    rows[firsts, 0] = begin
    return rows, counts


def average(sums: DataFrame, size: int) -> np.ndarray | None:
    """Mean weight vector from rows of (sum: vectors of doubles added up, n), FAN_IN rows to a task, level by level."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size), 0
        for batch in batches:
            for vector, k in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                total += np.frombuffer(vector.as_buffer())
                n += k
        yield summed(total, n)

    sums = cut_lineage(sums)
    left = sums.count()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        sums = sums.repartition(left).mapInArrow(add, SUM_FIELDS)
    rows = sums.collect()
    n = sum(r["n"] for r in rows)
    return sum(np.frombuffer(bytes(r["sum"])) for r in rows) / n if n else None


def summed(total: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.astype(np.float64).tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["sum", "n"])


def fit(texts: DataFrame, classes: Classes, vocabulary: str, rounds: int = ROUNDS) -> Weights:
    """Weights learned from every token of every text (columns text, h: a hash of the row)."""
    return learned_weights(stored(texts, vocabulary, rounds), classes, vocabulary, rounds)


def learned_weights(table: DataFrame, classes: Classes, vocabulary: str, rounds: int = ROUNDS) -> Weights:
    """Weights learned from every token of every stored text to learn from.

    Each text is cut into windows that cover it from end to end, and those
    are dealt over the rounds.  In a round, each shard of texts goes on from the
    common weights through its windows, in the order of their hashes; then
    the weights are averaged.  Shards and order follow from the rows and
    their number alone, not from partitions, so a rerun on any cluster learns the same.
    """
    table = table.where("round >= 0").select("round", "h", "windows", "n")
    shards = max(1, -(-(table.agg(F.sum("n")).first()[0] or 0) // WINDOWS_PER_SHARD))
    kind, class_of = token_type(vocabulary), np.append(classes.of, np.int16(-1))
    weights = Weights.initial(classes.counts)
    for round_no in range(rounds):
        now, rate = weights, RATE * (1 - round_no / rounds)

        def run(batches: Iterator[pa.RecordBatch], now: Weights = now, rate: float = rate) -> Iterator[pa.RecordBatch]:
            keep_memory()
            shard, adam, left, n = None, None, np.zeros((0, WINDOW + 1), np.int16), 0

            def ended() -> pa.RecordBatch:
                if len(left):
                    adam.step(left)
                return summed(adam.vector.astype(np.float64) * n, n)

            for batch in batches:
                numbers, ends = batch.column(0).to_numpy(), np.cumsum(batch.column(2).to_numpy())
                every = b"".join(batch.column(1).to_pylist())
                windows = class_of[np.frombuffer(every, kind)].reshape(-1, WINDOW + 1)
                lasts = np.append(np.flatnonzero(np.diff(numbers)), len(numbers) - 1) if len(numbers) else []
                first = 0
                for last in lasts:
                    if numbers[last] != shard:
                        if adam is not None:
                            yield ended()
                        shard, adam, left, n = numbers[last], Adam(now, rate), left[:0], 0
                    fresh = windows[first:ends[last]]
                    first = ends[last]
                    n += len(fresh)
                    left = np.concatenate([left, fresh])
                    whole = len(left) - len(left) % BATCH
                    for at in range(0, whole, BATCH):
                        adam.step(left[at:at + BATCH])
                    left = left[whole:]
            if adam is not None:
                yield ended()

        dealt = table.where(F.col("round") == round_no).select(F.pmod("h", F.lit(shards)).alias("shard"), "h", "windows", "n")
        dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "h", "windows").select("shard", "windows", "n")
        mean = average(dealt.mapInArrow(run, SUM_FIELDS), len(weights.vector))
        if mean is not None:
            weights = Weights(mean.astype(np.float32))
    return weights


def word_scores(spelled: np.ndarray, shares: list[np.ndarray], sizes: list[np.ndarray], known: list[np.ndarray], by_word: float, total: int) -> np.ndarray:
    """Log probability of each text, drawn one of two ways with even odds: all of its words spelled, or each either spelled or drawn by
    its count.  spelled: of all its subword classes; shares: log share of each subword in its class;
    sizes: subwords of each word; known: counts of its words, -1 if not frequent, out of total; by_word: weight of those counts."""
    if not shares:
        return np.zeros(0)
    flat = spelled + np.concatenate(shares)
    size, count = np.concatenate(sizes), np.concatenate(known)
    words_log = np.add.reduceat(flat, np.cumsum(size) - size)
    drawn = np.full(len(count), -np.inf)
    if by_word > 0:
        held = count > 0
        drawn[held] = np.log(by_word / total) + np.log(count[held])
    text = np.repeat(np.arange(len(sizes)), [len(x) for x in sizes])
    mixed = np.logaddexp(words_log + np.log(max(1e-300, 1 - by_word)), drawn)
    return np.logaddexp(np.bincount(text, words_log, len(sizes)), np.bincount(text, mixed, len(sizes))) - np.log(2)


def scores(docs: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens (long), base_score, score (double).

    Tokens are the lower-cased words of the whole text and one end.  The
    base score is the log10 probability by add-one word counts of the rows
    learned from.  score is the model's: the attention model spells each word
    by its subwords, each scored once.  A text has even odds of being spelled as
    a whole, or of having its frequent words drawn by their shares too, as often as a
    token of the corpus is a frequent word that occurs twice or more.  Null texts count as empty and have the end only; repeated rows are
    kept; an empty table gives an empty result; other columns are not read.

    Counts of words are kept by Spark; the frequent ones, at most FREQUENT,
    go along with the tasks, and the others meet their counts in a join,
    so that neither the driver nor a task holds all words, and no frequent
    word is a join key.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col, id_col).alias("h"))
    table = stored(docs.withColumn("learn", ~held_out("doc_id")), vocabulary, rounds)
    counts = cut_lineage(stored_counts(table))
    n_all, n_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least = least_frequent(counts)
    frequent = counts.where(F.col("n") >= least).select("word", "n").collect()
    frequent, counted = pa.array([r["word"] for r in frequent], pa.string()), np.array([r["n"] for r in frequent] + [-1], np.int64)
    ends = counts.where(F.col("word") == END).agg(F.sum("n")).first()[0] or 0
    classes = Classes(stored_subwords(table, vocabulary))
    weights = learned_weights(table, classes, vocabulary, rounds)
    held = counts.where(F.col("n") >= least)
    n_frequent, n_once = held.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") == 1)).first()
    by_word = max(0, n_frequent - n_once) / max(1, n_all)
    fields = StructType(docs.select("doc_id", "h").schema.fields + StructType.fromDDL("word string, k int, tokens long, known long, logs double, score double").fields)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        scorer, end = Scorer(weights, classes.counts), encoder(vocabulary)[1].size
        for batch in batches:
            words_of = [split_at(x) for x in batch.column(2)]
            # Counts of all chunks' words, -1 if a word is not frequent.
            at = pc.fill_null(pc.index_in(pa.chunked_array(words_of, pa.string()), frequent), len(frequent)).to_numpy()
            known_of = np.split(counted[at], np.cumsum([len(x) for x in words_of])[:-1])
            for doc_ids, h, found, known, *numbers in zip(batch.column(0), batch.column(1), words_of, known_of, *batch.columns[3:], strict=True):
                chunk, known = Chunk(*map(unpacked, numbers)), np.append(known, ends)
                n = len(chunk.lengths)
                tokens, sizes, places, word_sizes = chunk.spelled(end)
                of_text = chunk.lengths + 1
                own = np.repeat(np.arange(n), of_text)
                texts = np.split(classes.of[tokens], np.cumsum(sizes)[:-1])
                cuts = np.cumsum(of_text)[:-1]
                model = word_scores(scorer.positions(texts, classes.end), [classes.log_share[tokens]], np.split(word_sizes, cuts), np.split(known[places], cuts), by_word, max(1, n_frequent))
                logs = np.bincount(own, np.log10(np.maximum(known, 0) + 1.0)[places], n)
                n_known = np.bincount(own, (known > 0)[places], n).astype(np.int64)
                rare = known[places] < 0
                pairs, k = np.unique(own[rare] * len(known) + places[rare], return_counts=True)
                # A text's own row has a word that no text has, and that spreads these rows.
                spread = pa.array([f" {i} {t}" for i, t in enumerate(of_text.tolist())], pa.string())
                row, of = pa.array(np.concatenate([np.arange(n), pairs // len(known)])), pa.array(pairs % len(known))
                gone = pa.nulls(len(pairs))
                columns = [
                    doc_ids.values.take(row), h.values.take(row), pa.concat_arrays([spread, found.take(of)]), pa.array(np.concatenate([np.zeros(n, np.int64), k])),
                    *(pa.concat_arrays([pa.array(x), gone.cast(t)]) for x, t in ((of_text.astype(np.int64), pa.int64()), (n_known, pa.int64()), (logs, pa.float64()), (model / LN10, pa.float64()))),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    parts = chunks(table, "doc_ids", "hs", "words", "places", "lengths", "ids", "spans").mapInArrow(run, fields)
    rare = counts.where(F.col("n") < least)
    joined = parts.join(rare, "word", "left")
    c = F.coalesce("n", F.lit(0))
    summed_up = joined.groupBy("doc_id", "h").agg(
        *(F.max(x).alias(x) for x in ("tokens", "known", "logs", "score")), F.count("tokens").alias("rows"),
        F.sum(F.when(c > 0, F.col("k")).otherwise(F.lit(0))).alias("rare_known"), F.sum(F.col("k") * F.log10(c + F.lit(1.0))).alias("rare_logs"),
    )
    # Equal rows have added their equal parts up.
    out = summed_up.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    base = F.col("logs") + F.col("rare_logs") / F.col("rows") - F.col("tokens") * F.log10(F.lit(float(n_all + n_words + 1)))
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("tokens").alias("n_tokens"), (F.col("known") + F.floor(F.col("rare_known") / F.col("rows")).cast("long")).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
