"""Toxicity by a classifier chain: each category's linear model also sees the earlier categories' probabilities."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, hash64, held_out, map_batches, session_of

#: Labelled documents a combination of labels at most, features, folds, ridge, Newton steps.
SAMPLE, FEATURES, FOLDS, RIDGE, STEPS = 1500, 1500, 3, 1.0, 12
REMEMBERED = 300_000
#: Signs that may stand around a word.
SIGNS = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "¡¿«»“”„…–—"


def features(piece: str) -> list[int]:
    """Hashes of a run without blanks: its word in lower case, the word's beginnings, its signs, and whether it shouts."""
    word = piece.strip(SIGNS)
    low = word.lower()
    found = [f"w{low}"] if low else []
    found += [f"p{low[:n]}" for n in (3, 4, 5, 6) if len(low) > n]
    if len(word) < len(piece):
        at = piece.find(word) if word else 0
        found += [f"s{x}" for x in (piece[:at], piece[at + len(word) :]) if x]
    if len(word) > 1 and word.isupper():
        found.append("c")
    return [hash64(f.encode("utf-8", "surrogatepass")) >> 1 for f in found]


def document_features(text: str | None) -> set[int]:
    return {f for piece in set((text or "").split()) for f in features(piece)}


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by conjugate-gradient Newton steps; the last coefficient is the constant."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * w
        h = weight * np.maximum(p * (1 - p), 1e-6)
        step, r = np.zeros_like(w), g.copy()
        d, rr = r.copy(), r @ r
        if g @ g < 1e-6:
            break
        for _ in range(25):
            q = x.T @ (h * (x @ d)) + ridge * d
            a = rr / max(d @ q, 1e-30)
            step += a * d
            r -= a * q
            new = r @ r
            if new < 1e-4 * (g @ g):
                break
            d, rr = r + new / rr * d, new
        w -= step
    return w


@dataclass
class Chain:
    """The selected features, and for each category the coefficients: of the features, of earlier probabilities, a constant."""

    categories: list[str]
    place: dict[int, int]
    links: list[np.ndarray]
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def found(self, text: str | None) -> list[int]:
        out: set[int] = set()
        known = self.known
        for piece in set((text or "").split()):
            got = known.get(piece)
            if got is None:
                got = tuple({self.place[f] for f in features(piece) if f in self.place})
                if len(piece) < 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = got
            if got:
                out.update(got)
        return sorted(out)

    def probabilities(self, text: str | None) -> list[float]:
        at, out = self.found(text), []
        for k, w in enumerate(self.links):
            z = w[at].sum() + sum(p * w[len(self.place) + i] for i, p in enumerate(out)) + w[-1]
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out


def fit(rows: list[tuple[np.ndarray, list[int]]], categories: list[str], size: int = FEATURES) -> Chain:
    """Features are those whose presence differs most between a category and the rest; each link learns from out-of-fold probabilities.

    rows: the distinct features of a document, and its labels.
    """
    every = np.concatenate([found for found, _ in rows]) if rows else np.empty(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(found) for found, _ in rows])
    known, of, n = np.unique(every, return_inverse=True, return_counts=True)
    usual = np.nonzero(n > 2)[0]
    y = np.array([labels for _, labels in rows], dtype=float).reshape(len(rows), len(categories))
    chosen: dict[int, None] = {}
    for k in range(len(categories)):
        yes, with_yes = y[:, k].sum(), np.bincount(of, weights=y[owner, k], minlength=len(known))[usual]
        a, b = (with_yes + 0.5) / (yes + 1), (n[usual] - with_yes + 0.5) / (len(rows) - yes + 1)
        gap = np.abs(a - b) / np.sqrt((a + b) / 2)
        for i in usual[np.lexsort((known[usual], -gap))[: size // len(categories)]].tolist():
            chosen[i] = None
    place = {int(known[i]): column for column, i in enumerate(chosen)}
    column_of = np.full(len(known), -1)
    column_of[list(chosen)] = np.arange(len(chosen))
    x = np.zeros((len(rows), len(place) + len(categories)), dtype=np.float32)
    at = column_of[of]
    x[owner[at >= 0], at[at >= 0]] = 1
    fold, links = np.arange(len(rows)) % FOLDS, []
    for k in range(len(categories)):
        width = len(place) + k
        if not 0 < y[:, k].sum() < len(rows):
            w = np.zeros(width + 1)
            w[-1] = np.log((y[:, k].sum() + 0.5) / (len(rows) - y[:, k].sum() + 0.5)) if len(rows) else 0.0
        else:
            w = logistic(x[:, :width], y[:, k], np.ones(len(rows)))
        links.append(w)
        # what the next links learn from: each document's probability by a model that has not seen it
        for f in range(FOLDS):
            out = fold == f
            part = logistic(x[~out][:, :width], y[~out, k], np.ones((~out).sum())) if (~out).any() and out.any() else w
            x[out, width] = 1 / (1 + np.exp(-np.clip(x[out][:, :width] @ part[:-1] + part[-1], -30, 30)))
    return Chain(categories, place, links)


def train(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Learns from whole texts of at most ``sample`` documents of each combination of labels, those of least id hash.

    A row with a null id or a null label is not learned from. The ids are picked from the labels; their number is bounded.
    """
    session_of(docs)
    may = labels.where(" and ".join(f"{c} is not null" for c in [id_col, *categories])).where(~held_out(id_col))
    may = may.groupBy(F.col(id_col).alias("_id")).agg(*[F.max((F.col(c) > 0).cast("int")).alias(c) for c in categories])
    luck = F.xxhash64(F.col("_id").cast("string"), F.lit("sample"))
    chosen = None
    for combination in range(2 ** len(categories)):
        part = may.where(" and ".join(f"{c} = {combination >> i & 1}" for i, c in enumerate(categories))).orderBy(luck, "_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    chosen = chosen.select("_id", F.array(*categories).alias("_labels"))
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_doc", "text", "_labels")
    kind = dict(rows.dtypes)["_doc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(sorted(document_features(t.as_py())), dtype="<i8").tobytes() for t in column(batch, "text")]
            yield pa.RecordBatch.from_arrays([column(batch, "_doc"), pa.array(found, pa.binary()), column(batch, "_labels")], names=["_doc", "found", "_labels"])

    got = map_batches(rows, run, f"_doc {kind}, found binary, _labels array<int>").collect()
    got = sorted(got, key=lambda r: (hash64(str(r["_doc"]).encode()), r["found"]))
    return fit([(np.frombuffer(r["found"], dtype="<i8"), list(r["_labels"])) for r in got], categories)


def classify(docs: DataFrame, chain: Chain, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, p_<category> for each, score (the last category's) and predicted.

    Only the text decides. Null and blank texts have no features and get the constants' probabilities; null ids are
    never held out; rows that repeat give equal rows; an empty table gives no rows. Texts stay where they are.
    """
    sent = session_of(docs).sparkContext.broadcast(chain)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    names = ["doc_id", "held_out", *[f"p_{c}" for c in chain.categories], "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        for batch in batches:
            p = np.array([chain.probabilities(t.as_py()) for t in column(batch, "text")], dtype=float).reshape(batch.num_rows, -1)
            cols = [column(batch, "doc_id"), column(batch, "held_out"), *[pa.array(c) for c in p.T], pa.array(p[:, -1]), pa.array((p[:, -1] >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return map_batches(rows, run, f"doc_id {kind}, held_out boolean, " + "".join(f"p_{c} double, " for c in chain.categories) + "score double, predicted int")
