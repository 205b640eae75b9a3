"""Quality classifier by supervised subword embeddings: averaged hashed vectors, softmax, numpy stochastic gradient descent."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, held_out, map_batches, mix64, session_of, split_batch, sums

#: Labelled documents that are learned from at most, buckets and width of the vectors, passes, first step, n-gram lengths.
SAMPLE, BUCKETS, WIDTH, PASSES, STEP, SHORTEST, LONGEST = 4000, 1 << 18, 10, 6, 0.5, 3, 5
#: Score from which a document counts as good.
THRESHOLD = 0.3


def word_features(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word as it stands, case and signs included, and of its n-grams with the word's ends marked.

    Returns the buckets of all words in order, and where each word's end. All words are worked on as one array of code
    points, so a very long word costs what many short ones do.
    """
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(code)) - (ends - lengths)[owner]
    whole = np.zeros(len(words), dtype=np.uint64)
    np.add.at(whole, owner, mix64(code + (place.astype(np.uint64) << np.uint64(32)), 99))
    found, owners = [whole], [np.arange(len(words))]
    for n in range(SHORTEST, LONGEST + 1):
        if len(code) < n:
            continue
        h = np.full(len(code) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) ^ code[i : len(code) - n + 1 + i]
        inside = place[: len(h)] + n <= lengths[owner[: len(h)]]
        found.append(h[inside])
        owners.append(owner[: len(h)][inside])
    ids = (mix64(np.concatenate(found)) % np.uint64(buckets)).astype(np.int64)
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))])


def sampled(docs: DataFrame, labels: DataFrame, label: str, sample: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label) of at most ``sample`` labelled documents that are not held out, those of least id hash.

    Ids are picked from the labels alone; that many are a bounded table, so their texts are found without moving texts.
    """
    chosen = labels.where(f"{label} is not null and {id_col} is not null").where(~held_out(id_col))
    chosen = chosen.groupBy(F.col(id_col).alias("_id")).agg(F.min(label).alias("_label"))
    chosen = chosen.orderBy(F.xxhash64(F.col("_id").cast("string"), F.lit("sample")), "_id").limit(sample)
    return docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select(F.col("_doc").alias("doc_id"), "text", F.col("_label").alias("label"))


@dataclass
class Model:
    """What the trained network does to one bucket: its vector times the difference of the two outputs' weights."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The softmax output of good for the mean over all words and n-grams; a text without words has the bias alone."""
        words, places, ends = split_batch(texts)
        if not words:
            return np.full(len(texts), 1 / (1 + np.exp(-self.bias)))
        ids, stops = word_features(words, len(self.weight))
        value = sums(self.weight[ids], stops)
        n = sums(np.diff(stops)[places], ends)
        z = self.bias + sums(value[places], ends) / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on whole texts of the sample; without two classes the score is the share of good ones (a half if none)."""
    session_of(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for t in column(batch, "text"):
                words = Counter((t.as_py() or "").split())
                found, stops = word_features(list(words), buckets)
                times = np.repeat(np.fromiter(words.values(), dtype=np.float64, count=len(words)), np.diff(stops))
                some, at = np.unique(found, return_inverse=True)
                ids.append(some.astype("<i4").tobytes())
                counts.append(np.bincount(at, times, len(some)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary()), column(batch, "label")], names=["doc_id", "ids", "counts", "label"])

    chosen = sampled(docs, labels, label, sample, id_col, text_col).withColumn("label", F.col("label").cast("int"))
    kind = dict(chosen.dtypes)["doc_id"]
    rows = sorted(map_batches(chosen, count, f"doc_id {kind}, ids binary, counts binary, label int").collect(), key=lambda r: (r["doc_id"], r["ids"]))
    return fit([(np.frombuffer(r["ids"], dtype="<i4"), np.frombuffer(r["counts"], dtype="<f4"), int(r["label"] > 0)) for r in rows], buckets)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS) -> Model:
    rng = np.random.default_rng(5)
    good = sum(y for *_, y in rows)
    prior = float(np.log((good + 0.5) / (len(rows) - good + 0.5)))
    if not 0 < good < len(rows):
        return Model(np.zeros(buckets), prior)
    vectors = ((rng.random((buckets, WIDTH), dtype=np.float32) - 0.5) / WIDTH).astype(np.float32)
    out, bias = np.zeros((2, WIDTH), dtype=np.float32), np.array([0, prior], dtype=np.float32)
    rows = [(i, c / max(c.sum(), 1), y) for i, c, y in rows]
    steps, done = PASSES * len(rows), 0
    for _ in range(PASSES):
        for k in rng.permutation(len(rows)):
            ids, share, y = rows[k]
            rate = STEP * (1 - done / steps)
            done += 1
            hidden = share @ vectors[ids] if len(ids) else np.zeros(WIDTH, dtype=np.float32)
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ out
            out -= rate * p[:, None] * hidden
            bias -= rate * p * 0.1
            # every feature of the mean gets the whole step, as in the public method
            if len(ids):
                vectors[ids] -= np.minimum(share * len(ids), 4)[:, None] * (rate * back)
    return Model((vectors @ (out[1] - out[0])).astype(np.float64), float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Only the text decides.

    Null and blank texts get the score of the bias; null ids are never held out; rows that repeat give equal rows; an
    empty table gives no rows. The model is a number a bucket, whatever the corpus.
    """
    sent = session_of(docs).sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            s = model.scores(column(batch, "text").to_pylist())
            cols = [column(batch, "doc_id"), column(batch, "held_out"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted"])

    return map_batches(rows, run, f"doc_id {kind}, held_out boolean, score double, predicted int")
