"""Byte-level BPE with a public vocabulary: a priority queue of merge ranks over a doubly linked symbol list.

Text is split by the vocabulary's pattern; each piece is a linked list of symbols.  The queue holds (rank,
position, end) of adjacent pairs; the lowest rank is merged first, leftmost first, and entries whose symbols have
changed meanwhile are skipped as stale, so a piece of n bytes takes O(n log n) however long it is.  Decoding
concatenates the vocabulary's strings.

Defined results: null and empty texts give the empty list; strings that look like special tokens are text.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import spread

#: Where the vocabularies of the public tokenizers are, unless the caller names another place.
TOKENIZERS = "/opt/tokenizers"

# Fixed value: the pattern that splits text before the merges of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class BytePairs:
    """One vocabulary of ranks; pieces that occur again are looked up in a bounded cache."""

    def __init__(self, path: str, cache: int = 1 << 16):
        import regex

        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.text = {i: b for b, i in self.rank.items()}
        self.pieces = regex.compile(PATTERN).findall
        self.piece = lru_cache(cache)(self._piece)

    def _piece(self, piece: str) -> tuple[int, ...]:
        raw, rank = piece.encode("utf-8", "surrogatepass"), self.rank
        if raw in rank:
            return (rank[raw],)
        n = len(raw)
        end = list(range(1, n + 1))  # of the symbol that starts here; 0 once it is merged into another
        before = list(range(-1, n - 1))
        queue = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := rank.get(raw[i : end[j]])) is not None:
                heapq.heappush(queue, (r, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, stop = heapq.heappop(queue)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # stale: one of the two symbols has grown or is gone
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        ids, i = [], 0
        while i < n:
            ids.append(rank[raw[i : end[i]]])
            i = end[i]
        return tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for p in self.pieces(text or ""):
            out.extend(self.piece(p) if len(p) < 64 else self._piece(p))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.text[i] for i in ids).decode("utf-8", "replace")


@lru_cache(2)
def vocabulary(path: str) -> BytePairs:
    """One vocabulary for each Python worker."""
    return BytePairs(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))


def encode(df: DataFrame, doc_id: str, text: str, path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """``(doc_id, ids)``: every text as the ids of the vocabulary at ``path``; row-local, without a shuffle."""
    if os.path.exists(path):
        df.sparkSession.sparkContext.addFile(path)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = vocabulary(path)
        for b in batches:
            for k in range(0, b.num_rows, 500):  # the lists of a few hundred texts at a time
                part = b.slice(k, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([book.encode(t) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return spread(df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")), "doc_id").mapInArrow(ids, "doc_id bigint, ids array<int>")


def decode(df: DataFrame, doc_id: str, ids: str, path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """``(doc_id, text)`` of lists of ids; a null list gives an empty text."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = vocabulary(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([book.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids")).mapInArrow(texts, "doc_id bigint, text string")
