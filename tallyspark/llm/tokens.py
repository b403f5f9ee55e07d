"""Encoding texts with a public byte-level BPE (problem 8).

A text is cut into words by the vocabulary's pattern; a word is encoded over a contiguous array of part boundaries and
the ranks of adjacent parts: scan for the smallest rank, delete that boundary, refresh the two neighbouring ranks. Words
repeat, so each Python worker keeps a bounded table of those it has met. Only Arrow batches cross between JVM and Python.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

FOLDER = "/opt/tokenizers"
#: Fixed value: the published word pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_RANK = 1 << 60
#: Bytes up to which a word is scanned; the scan is quadratic, so longer ones are merged by a heap.
SHORT = 160
#: Words a worker remembers before it starts anew.
REMEMBERED = 400_000


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a short word by repeated scans of the rank array."""
    cuts = list(range(len(word) + 1))
    rank = [ranks.get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while rank:
        low = min(rank)
        if low == NO_RANK:
            break
        i = rank.index(low)
        del cuts[i + 1], rank[i]
        if i < len(rank):
            rank[i] = ranks.get(word[cuts[i] : cuts[i + 2]], NO_RANK)
        if i:
            rank[i - 1] = ranks.get(word[cuts[i - 1] : cuts[i + 1]], NO_RANK)
    return [ranks[word[a:b]] for a, b in zip(cuts, cuts[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids for a word of any length: a heap of (rank, left part) over a linked list of parts, O(n log n)."""
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapify(heap)
    alive = [True] * n
    while heap:
        _, i, to = heappop(heap)
        if not alive[i] or (j := after[i]) >= n or end[j] != to:
            continue
        alive[j], end[i], after[i] = False, to, after[j]
        if after[j] < n:
            before[after[j]] = i
            if (r := ranks.get(word[i : end[after[j]]])) is not None:
                heappush(heap, (r, i, end[after[j]]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:to])) is not None:
            heappush(heap, (r, h, to))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class Words(dict):
    """Word -> ids, filled as words are met and emptied when full."""

    def __init__(self, ranks: dict[bytes, int], most: int = REMEMBERED):
        super().__init__()
        self.ranks, self.most = ranks, most

    def __missing__(self, word: str) -> tuple[int, ...]:
        b = word.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(b)
        ids = (whole,) if whole is not None else tuple((merge_short if len(b) <= SHORT else merge_long)(b, self.ranks))
        if len(b) <= SHORT:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.words = Words({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)})
        self.pattern = regex.compile(PATTERN)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text without special tokens; an empty list for an empty and for a null text."""
        if not text:
            return []
        found = self.pattern.findall(text) if len(text) < 1_000_000 else (m.group() for m in self.pattern.finditer(text))
        return list(chain.from_iterable(map(self.words.__getitem__, found)))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary(name: str, folder: str = FOLDER) -> str:
    return f"{folder}/{name}.tiktoken"


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids array<int>), one per row of docs; null and empty texts get an empty list. Other columns are not read."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            for part in _pieces(b):
                ids = [np.array(e.encode(t), dtype=np.int32) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))], names=["id", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>")


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (id, n_tokens, and the columns in keep), one per row of docs."""
    schema = ", ".join([f"id {docs.schema[id_col].dataType.simpleString()}", "n_tokens long", *[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            n = pa.array([len(e.encode(t)) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n, *b.columns[2:]], names=["id", "n_tokens", *keep])

    return docs.select(id_col, text_col, *keep).mapInArrow(run, schema)


def _pieces(b: pa.RecordBatch, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for i in range(0, b.num_rows, rows):
        yield b.slice(i, rows)
