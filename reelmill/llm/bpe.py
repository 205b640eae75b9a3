"""Byte-level BPE by a hierarchical-bitmap rank queue: no token list is scanned twice, however long the pre-token."""

from __future__ import annotations

import base64
import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches
from .pretokens import cutter, pieces

#: Pieces, and pre-tokens, in each of the two generations that a Python worker remembers.
REMEMBERED = 400_000
#: Bytes of pre-tokens that share one rank queue; a longer pre-token has one to itself.
SHARED = 1 << 17


class RankQueue:
    """Buckets of positions by merge rank under bitmaps of three levels; the lowest set bit finds the next rank."""

    __slots__ = ("buckets", "filled", "low", "middle", "top")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.filled: dict[int, np.ndarray] = {}
        self.low: dict[int, int] = {}
        self.middle: dict[int, int] = {}
        self.top = 0

    def fill(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Puts many positions, ascending, under their ranks into an empty queue."""
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        found, starts = np.unique(ranks[order], return_index=True)
        for rank, group in zip(found.tolist(), np.split(positions[order], starts[1:]), strict=True):
            self._mark(rank)
            self.buckets[rank] = []
            self.filled[rank] = group

    def _mark(self, rank: int) -> None:
        a, b = rank >> 6, rank >> 12
        self.low[a] = self.low.get(a, 0) | 1 << (rank & 63)
        self.middle[b] = self.middle.get(b, 0) | 1 << (a & 63)
        self.top |= 1 << b

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self._mark(rank)
        else:
            bucket.append(position)

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank that holds positions, and these in ascending order; the bucket is then empty."""
        if not self.top:
            return None
        b = (self.top & -self.top).bit_length() - 1
        m = self.middle[b]
        a = b << 6 | (m & -m).bit_length() - 1
        w = self.low[a]
        rank = a << 6 | (w & -w).bit_length() - 1
        if w := w & (w - 1):
            self.low[a] = w
        else:
            del self.low[a]
            if m := m & (m - 1):
                self.middle[b] = m
            else:
                del self.middle[b]
                self.top &= self.top - 1
        positions = self.buckets.pop(rank)
        if (first := self.filled.pop(rank, None)) is not None:
            positions = first.tolist() + positions
        positions.sort()
        return rank, positions


class Encoder:
    """Encodes and decodes by a table of ranks (bytes -> id, the id being the merge rank) and a pre-token pattern.

    Ids are kept as bytes, ``kind`` an id. What was not used while the younger generation filled up is forgotten, so
    common pieces stay however long a task runs.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = REMEMBERED):
        self.ranks, self.pretokens, self.remembered = ranks, cutter(pattern), remembered
        self.bytes_of = {i: b for b, i in ranks.items()}
        # one more than any id stands for "no part here"; a pair's key is left * base + right
        self.nothing = max(ranks.values()) + 1
        self.base = self.nothing + 1
        self.kind = np.dtype("<u2" if self.base <= 1 << 16 else "<u4")
        self.pairs: dict[int, int] = {}
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = get(token[:cut]), get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.base + right] = rank
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.byte_pairs = np.array([[get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], dtype=np.int32)
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}

    def merge(self, tokens: list[bytes]) -> list[bytes]:
        """The ids of each pre-token: always the lowest rank first, the leftmost position of that rank first.

        The pre-tokens lie behind each other, with a gap after each, under one queue: a bucket holds positions of all.
        """
        nothing, base, get = self.nothing, self.base, self.pairs.get
        ends = np.cumsum([len(t) + 1 for t in tokens]) - 1  # the gaps
        laid = np.frombuffer(b"\0".join(tokens) + b"\0", dtype=np.uint8)
        ids, first = self.byte_ids[laid], self.byte_pairs[laid[:-1], laid[1:]]
        ids[ends] = nothing
        first[ends[:-1]] = first[ends - 1] = -1
        queue, at = RankQueue(), np.nonzero(first >= 0)[0]
        queue.fill(first[at], at)
        # a linked list of parts: a part is named by its first byte; what is merged away becomes nothing. pair has the
        # rank of each part with the one after it
        n = len(laid)
        part, pair, after, before = ids.tolist(), first.tolist(), list(range(1, n + 1)), list(range(-1, n))
        if n > 2 * SHARED:  # a long pre-token: slower, but in a sixth of the memory
            part, pair, after, before = array("i", part), array("i", pair), array("i", after), array("i", before)
        gaps = ends.tolist()
        while (found := queue.pop()) is not None:
            rank, positions = found
            wait = -1
            for i in positions:
                if i < wait:
                    queue.push(rank, i)
                    continue
                if pair[i] != rank:
                    continue  # stale: a part of this pair was merged meanwhile
                middle = after[i]
                last = after[middle]
                part[i], part[middle], pair[middle] = rank, nothing, -1
                after[i], before[last] = last, i
                pair[i] = right = get(rank * base + part[last], -1)
                if right >= 0:
                    queue.push(right, i)
                    if right < rank:
                        wait = gaps[bisect_left(gaps, i)]
                if i:
                    prior = before[i]
                    left = get(part[prior] * base + rank, -1)
                    pair[prior] = left
                    if left >= 0:
                        queue.push(left, prior)
                        if left < rank:  # a lower rank came up: the rest of this pre-token's positions waits
                            wait = gaps[bisect_left(gaps, i)]
        out = np.array(part, dtype=np.int32)
        there = out != nothing
        cuts = [0, *(np.cumsum(there)[ends] * self.kind.itemsize).tolist()]
        data = out[there].astype(self.kind).tobytes()
        return [data[a:b] for a, b in pairwise(cuts)]

    def _learn_words(self, new: set[str]) -> None:
        """Adds the ids of pre-tokens, merged in groups of bounded size."""
        known, older, group, size = self.words, self.older_words, [], 0
        for word in new:
            ids = older.get(word)
            if ids is None:
                token = word.encode()
                if (whole := self.ranks.get(token)) is None:
                    group.append((word, token))
                    size += len(token)
                    if size >= SHARED:
                        known.update(zip((w for w, _ in group), self.merge([t for _, t in group]), strict=True))
                        group, size = [], 0
                    continue
                ids = whole.to_bytes(self.kind.itemsize, "little")
            known[word] = ids
        if group:
            known.update(zip((w for w, _ in group), self.merge([t for _, t in group]), strict=True))

    def _learn(self, new: set[str]) -> None:
        """Adds the ids of pieces."""
        known, older, cut = self.parts, self.older_parts, {}
        for p in new:
            if (ids := older.get(p)) is None:
                cut[p] = self.pretokens(p)
            else:
                known[p] = ids
        words = {w for c in cut.values() for w in c}
        self._learn_words(words.difference(self.words))
        get = self.words.__getitem__
        for p, c in cut.items():
            known[p] = get(c[0]) if len(c) == 1 else b"".join(map(get, c))
        for w in words:
            if len(w) >= 64:
                del self.words[w]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Pieces of at least 64 characters are forgotten afterwards."""
        if len(self.parts) > self.remembered:
            self.older_parts, self.parts = self.parts, {}
        if len(self.words) > self.remembered:
            self.older_words, self.words = self.words, {}
        cut, known = [pieces(t) for t in texts], self.parts
        found = [list(map(known.get, c)) for c in cut]
        gaps = [[i for i, ids in enumerate(f) if ids is None] for f in found]
        new = {c[i] for c, g in zip(cut, gaps, strict=True) for i in g}
        self._learn(new)
        for c, f, g in zip(cut, found, gaps, strict=True):
            for i in g:
                f[i] = known[c[i]]
        for p in new:
            if len(p) >= 64:
                del known[p]
        return [np.frombuffer(b"".join(f), dtype=self.kind) for f in found]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(2)
def encoder(path: str, pattern: str, remembered: int = REMEMBERED) -> Encoder:
    """One encoder a Python worker; the vocabulary file is read where it is installed."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Encoder(ranks, pattern, remembered)


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """One row per document: doc_id, ids (array), decoded (the bytes that the ids stand for).

    Null text counts as empty and has no ids; null and repeated ids pass through; an empty table gives no rows. The
    vocabulary's path is a parameter and must be installed on every executor. Nothing moves between executors.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern, remembered)
        for batch in batches:
            ids = e.encode(column(batch, "text").to_pylist())
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            values = pa.array(np.concatenate(ids).astype(np.int32) if ids else [], pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends), values)
            cols = [column(batch, "doc_id"), lists, pa.array([e.decode(i.tolist()) for i in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "ids", "decoded"])

    return map_batches(rows, run, f"doc_id {kind}, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """As ``encoded``, with digests in place of ids and bytes: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        decimal = {i: str(i) for i in e.bytes_of}.__getitem__
        for batch in batches:
            out: list[list] = [[], [], []]
            for found in e.encode(column(batch, "text").to_pylist()):
                ids = found.tolist()
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                out[2].append(hashlib.sha256(e.decode(ids)).hexdigest())
            cols = [column(batch, "doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1]), pa.array(out[2])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
