"""Document fingerprints from Lempel-Ziv phrases: the phrase set, hashed, kept as its smallest hashes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, mix64, ordered_parts

#: Smallest hashes that a fingerprint keeps.
SIGNATURE = 256
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def parse(data: bytes, trie: dict[int, int], node: int = 0) -> int:
    """Reads bytes into the phrase trie and returns the node where it stopped.

    A phrase is the shortest run not yet in the dictionary. A node's number is 256 times its rank of insertion; the key
    of a child is that number plus the byte, in order of insertion.
    """
    get, size = trie.get, len(trie) + 1
    for c in data:
        key = node + c
        node = get(key)
        if node is None:
            trie[key] = size << 8
            size += 1
            node = 0
    return node


def phrase_hashes(trie: dict[int, int]) -> np.ndarray:
    """A hash of each phrase's bytes: level by level from the root, until no phrase changes."""
    keys = np.fromiter(trie.keys(), dtype=np.uint64, count=len(trie))
    parent, byte = (keys >> np.uint64(8)).astype(np.int64), (keys & np.uint64(255)) + np.uint64(1)
    h = np.zeros(len(keys) + 1, dtype=np.uint64)
    depth = np.zeros(len(keys) + 1, dtype=np.int64)
    while True:
        new = depth[parent] + 1
        h[1:] = mix64(h[parent] + byte)
        if (new == depth[1:]).all():
            return h[1:]
        depth[1:] = new


def signature(trie: dict[int, int], k: int = SIGNATURE) -> np.ndarray:
    """The k smallest distinct 32-bit hashes of the phrase set, ascending."""
    h = np.unique((phrase_hashes(trie) >> np.uint64(32)).astype("<u4"))
    return h[:k]


def fingerprint(data: bytes, k: int = SIGNATURE) -> np.ndarray:
    trie: dict[int, int] = {}
    parse(data, trie)
    return signature(trie, k)


def likeness(a: np.ndarray, b: np.ndarray, k: int = SIGNATURE) -> float:
    """The share of the k smallest hashes of the union that both have: 1 for equal fingerprints, also for two empty ones."""
    both = np.sort(np.concatenate([a, b]))
    same = both[1:] == both[:-1]
    union = np.concatenate([both[:1], both[1:][~same]])[:k]
    if not len(union):
        return 1.0
    return float(np.searchsorted(both[1:][same], union[-1], side="right")) / len(union)


def text_of(sig: np.ndarray) -> str:
    return base64.b64encode(sig.tobytes()).decode()


class _Open:
    """A document that waits for the next one: its text, its signature, and the trie as it was before the edited tail."""

    def __init__(self, doc_id: int | None, text: str, k: int):
        self.doc_id, self.text, self.k = doc_id, text, k
        self.tail = len(text) // 4
        self.head = text[: len(text) - self.tail]
        trie: dict[int, int] = {}
        self.node = parse(self.head.encode(), trie)
        self.trie = trie.copy() if self.tail else trie
        parse(text[len(text) - self.tail :].encode(), trie, self.node)
        self.sig = signature(trie, k)

    def row(self, following: str, following_sig: np.ndarray) -> tuple:
        put = following[: self.tail]
        parse(put.encode(), self.trie, self.node)
        edited_sig = signature(self.trie, self.k)
        sha = hashlib.sha256((self.head + put).encode()).hexdigest()
        return (self.doc_id, len(self.text), sha, text_of(self.sig), text_of(edited_sig), likeness(self.sig, edited_sig, self.k), likeness(self.sig, following_sig, self.k))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SIGNATURE) -> DataFrame:
    """One row per document: fingerprint, and how like it is to its edited text and to the next document.

    The edited text has its last quarter of code points replaced by the first as many of the next document by ascending
    id (the last takes the first). Null text counts as empty; a null id sorts first; rows that share an id are ordered
    by text; a lone document is its own next one; an empty table gives no rows. Other columns are not read.

    Rows move once, into ascending ranges of ids; the first document of a range is also sent to the range before, so no
    range needs another. A quarter of a text is parsed twice, the rest once. A task holds two documents at a time.
    """
    lowest = -(2**63)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("_key", F.coalesce("doc_id", F.lit(lowest)))
    cut, bounds = ordered_parts(rows, "_key")
    firsts = sorted((r["_part"], r["first"]) for r in cut.groupBy("_part").agg(F.min("_key").alias("first")).collect())
    if not firsts:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    n = len(bounds) + 1
    # the last range's successor is the first range's first document
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    wanted = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    slots = F.filter(F.array(F.col("_part") * 2, wanted[F.col("_key")] * 2 + 1), lambda s: s.isNotNull())
    dealt = cut.withColumn("_slot", F.explode(slots)).repartitionById(n, F.expr("_slot div 2").cast("int"))
    dealt = dealt.sortWithinPartitions("_slot", "_key", "text").select("doc_id", "text", "_slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_doc, out = None, []
        for batch in batches:
            for doc_id, text, slot in zip(column(batch, "doc_id").to_pylist(), column(batch, "text"), column(batch, "_slot").to_pylist(), strict=True):
                if slot & 1 and open_doc is None:
                    continue
                now = _Open(doc_id, text.as_py(), k)
                if open_doc is not None:
                    out.append(open_doc.row(now.text, now.sig))
                open_doc = None if slot & 1 else now
            if out:
                yield _batch(out)
                out = []

    return map_batches(dealt, run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
