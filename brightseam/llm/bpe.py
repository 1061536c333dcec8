"""Encoding a corpus with a public byte-level BPE tokenizer."""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .images import table

#: The pattern that cuts a text into pieces before the merges, as the tokenizer's files state it; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = 1 << 62


def vocabulary_path(name: str, folder: str | None = None) -> str:
    """The rank file of a tokenizer; ``folder`` or BRIGHTSEAM_TOKENIZERS names where the files lie, on every executor."""
    folder = folder or os.environ.get("BRIGHTSEAM_TOKENIZERS") or "/opt/tokenizers"
    return os.path.join(folder, name if "." in name else f"{name}.tiktoken")


class MergeTree:
    """Segment tree over the ranks of adjacent pairs of one piece.

    A leaf holds rank * 2^32 + place of the pair that starts there, so the root is the leftmost of the pairs of lowest
    rank.  A merge changes at most three leaves, each with a walk to the root.
    """

    def __init__(self, keys: list[int]):
        n = 1
        while n < len(keys):
            n *= 2
        self.n = n
        self.t = [_NONE] * n + keys + [_NONE] * (n - len(keys))
        for i in range(n - 1, 0, -1):
            a, b = self.t[2 * i], self.t[2 * i + 1]
            self.t[i] = a if a < b else b

    def set(self, i: int, key: int) -> None:
        t, i = self.t, i + self.n
        t[i] = key
        i >>= 1
        while i:
            a, b = t[2 * i], t[2 * i + 1]
            low = a if a < b else b
            if t[i] == low:
                break
            t[i] = low
            i >>= 1


class ByteBpe:
    """Byte-level BPE with the ranks of a vocabulary file; special tokens are ordinary text."""

    def __init__(self, path: str, pattern: str = PATTERN, remembered: int = 1 << 18):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        self.pieces = regex.compile(pattern)
        self.known: dict[str, tuple[int, ...]] = {}
        self.remembered = remembered

    def merge(self, piece: bytes) -> tuple[int, ...]:
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        end = list(range(1, n + 1))  # of the part that starts here
        prev = list(range(-1, n - 1))
        get = ranks.get
        keys = [(r << 32 | i) if (r := get(piece[i : i + 2])) is not None else _NONE for i in range(n - 1)]
        tree = MergeTree(keys)
        t = tree.t
        while (low := t[1]) != _NONE:
            i = low & 0xFFFFFFFF
            j = end[i]
            stop = end[i] = end[j]
            tree.set(j, _NONE) if j < n - 1 else None
            if stop < n:
                prev[stop] = i
                r = get(piece[i : end[stop]])
                tree.set(i, _NONE if r is None else r << 32 | i)
            else:
                tree.set(i, _NONE)
            p = prev[i]
            if p >= 0:
                r = get(piece[p:stop])
                tree.set(p, _NONE if r is None else r << 32 | p)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for an empty and for a NULL text.  Lone surrogates count as U+FFFD."""
        if not text:
            return []
        known, out = self.known, []
        for p in self.pieces.findall(text):
            ids = known.get(p)
            if ids is None:
                ids = self.merge(p.encode("utf-8", "replace"))
                if len(p) <= 64:
                    if len(known) >= self.remembered:
                        known.clear()
                    known[p] = ids
            out += ids
        return out


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteBpe:
    """One for each path and worker process."""
    return ByteBpe(path)


def encode_column(docs: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """(key, ids) of every row: ``ids`` is empty for an empty or NULL text.  Rows stay in their tasks; no shuffle."""

    def encode(batches):
        bpe = tokenizer(path)
        for b in batches:
            each = [bpe.encode(x) for x in b.column(1).to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(e) for e in each]))).astype(np.int32)
            flat = np.fromiter((i for e in each for i in e), np.int32, int(ends[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [key, "ids"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(encode, f"`{key}` {kind}, ids array<int>")


def token_counts(docs: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """(key, n_tokens) of every row."""

    def count(batches):
        bpe = tokenizer(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(bpe.encode(x)) for x in b.column(1).to_pylist()], pa.int64())], [key, "n_tokens"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(count, f"`{key}` {kind}, n_tokens bigint")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_column(table(spark, folder, "documents"), "doc_id", "text", vocabulary_path("byte_bpe_50k"))


def p8_check(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, sha256) of the text that each document's ids spell; of no ids, that of the empty text."""
    path = vocabulary_path("byte_bpe_50k")

    def spell(batches):
        parts = {i: b for b, i in tokenizer(path).ranks.items()}
        for b in batches:
            got = [hashlib.sha256(b"".join(parts[i] for i in ids)).hexdigest() for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.string())], ["doc_id", "sha256"])

    return p8_ids(spark, folder).mapInArrow(spell, "doc_id bigint, sha256 string")
