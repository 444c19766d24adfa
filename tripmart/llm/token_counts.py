"""Token counts of sections: whole documents encoded once, tokens attributed by their character spans."""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.text import per_text

#: Ranks of a byte-level BPE vocabulary, and the pattern that cuts texts before merging (fixed value of that vocabulary).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("start", "majority", "proportional")


@lru_cache(maxsize=4)
def encoder(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding of a vocabulary file, and each token's length in bytes."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def token_spans(text: str, path: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) in characters of each token of a whole text.

    Tokens are bytes: one that has only some of a character's bytes spans that character.
    """
    encoding, sizes = encoder(path)
    lengths = sizes[encoding.encode_ordinary(text)]
    end = np.cumsum(lengths)
    start = end - lengths
    raw = text.encode()
    if len(raw) == len(text) or not len(end):
        return start, end
    char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    return char[start], char[end - 1] + 1


def allocate(start: np.ndarray, end: np.ndarray, begins: np.ndarray, ends: np.ndarray, rule: str = "start") -> np.ndarray:
    """Tokens of each section, and last those of none.

    Sections are ordered by start; one that runs into the next ends there.
    A token inside one section is that section's.  One that crosses a boundary
    goes to the section of its first character ("start"), to the one with
    most of its characters, the earlier of equals ("majority"), or is shared
    in proportion to characters ("proportional").
    """
    n = len(begins)
    out = np.zeros(n + 1)
    if n:
        ends = np.minimum(ends, np.append(begins[1:], np.iinfo(np.int64).max))

    def owner(at: np.ndarray) -> np.ndarray:
        if not n:
            return np.zeros(len(at), np.int64)
        i = np.searchsorted(begins, at, "right") - 1
        return np.where((i >= 0) & (at < ends[i]), i, n)

    first, last = owner(start), owner(end - 1)
    if rule == "start":
        return np.bincount(first, minlength=n + 1).astype(float)
    # The gap between two sections lies between tokens' ends too: only equal owners without a boundary inside are whole.
    inside = (first == last) & ((first < n) | (np.searchsorted(begins, start, "right") == np.searchsorted(begins, end - 1, "right")) if n else True)
    out += np.bincount(first[inside], minlength=n + 1)
    for s, e in zip(start[~inside].tolist(), end[~inside].tolist(), strict=True):
        owners, sizes = np.unique(owner(np.arange(s, e)), return_counts=True)
        if rule == "proportional":
            out[owners] += sizes / (e - s)
        else:
            out[min(owners[sizes == sizes.max()], key=lambda i: (i == n, i))] += 1
    return out


def paragraphs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of the lines of a text, each with the line break that ends it."""
    cuts, at = [0], text.find("\n")
    while at >= 0:
        cuts.append(at + 1)
        at = text.find("\n", at + 1)
    if cuts[-1] == len(text) and text:
        cuts.pop()
    return np.array(cuts), np.array([*cuts[1:], len(text)])


def section_tokens(docs: DataFrame, rule: str = "start", vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph of each row: doc_id, section (from 0), begin, end (characters), n_tokens (double), doc_tokens (long).

    Each whole text is encoded once and its tokens are attributed to
    paragraphs by rule, so that a row's sections add up to doc_tokens.  Null
    and empty texts have one empty section of 0 tokens; repeated rows are kept,
    an empty table gives an empty result, other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def start():
        def work(texts):
            index, columns = [], [[], [], [], [], []]
            for at, t in enumerate(texts):
                spans, (begins, ends) = token_spans(t or "", vocabulary), paragraphs(t or "")
                counts = allocate(*spans, begins, ends, rule)[:-1]
                index += [at] * len(begins)
                for column, values in zip(columns, (np.arange(len(begins)), begins, ends, counts, np.full(len(begins), len(spans[0]))), strict=True):
                    column.append(values)
            return index, [np.concatenate(c) if c else np.zeros(0) for c in columns]

        return work

    fields = "section int, begin long, end long, n_tokens double, doc_tokens long"
    return per_text(docs, [(id_col, "doc_id")], text_col, fields, start)


def field_tokens(docs: DataFrame, fields: list[str], separator: str = "\n", rule: str = "start", vocabulary: str = VOCABULARY, id_col: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, doc_tokens, n_<field> and n_rest (doubles).

    The document is its fields, null ones empty, joined by the separator and
    encoded once; tokens of the separators are n_rest.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    lengths = F.array(*map(F.length, texts))  # per_text takes one string: the joined text with its fields' lengths
    packed = F.to_json(F.struct(lengths.alias("n"), F.concat_ws(separator, *texts).alias("t")))
    whole = docs.select(F.col(id_col).alias("doc_id"), packed.alias("packed"))

    def start():
        def work(batch):
            totals, counts = [], []
            for packed in batch:
                x = json.loads(packed)
                ends = np.cumsum(np.array(x["n"]) + len(separator)) - len(separator)
                spans = token_spans(x["t"], vocabulary)
                counts.append(allocate(*spans, ends - np.array(x["n"]), ends, rule).tolist())
                totals.append(len(spans[0]))
            return None, [totals, counts]

        return work

    out = per_text(whole, [("doc_id", "doc_id")], "packed", "doc_tokens long, counts array<double>", start)
    names = [*(f"n_{c}" for c in fields), "n_rest"]
    return out.select("doc_id", "doc_tokens", *(F.col("counts")[i].alias(c) for i, c in enumerate(names)))
