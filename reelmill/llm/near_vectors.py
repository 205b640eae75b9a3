"""Embedding near-dedup: randomised-rotation binary codes with stored correction factors decide which pairs are recomputed."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, discard, map_batches, session_of, written
from .components import components

#: Vectors of a block, blocks of codes that a task scans, pairs of a block that are looked at together.
BLOCK, SCANNED, TILE = 2048, 64, 512
#: What rounding in single precision may take from an estimate.
SLACK = 1e-4


@lru_cache(4)
def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix: the same on every executor."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def units(vectors: np.ndarray) -> np.ndarray:
    """The vectors over their lengths; scaled first, so that very long and very short ones keep their direction."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors and each one's correction factor, its inner product with its code."""
    turned = unit @ turn
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(1) / math.sqrt(unit.shape[1])


def estimates(queries: np.ndarray, codes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the inner products of rotated unit vectors with coded ones.

    With code c of vector o (all of length 1), s = <c, q> and f = <c, o>: s / f is the estimate.
    """
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * np.float32(2 / math.sqrt(dim)) - np.float32(1 / math.sqrt(dim))
    return (queries.astype(np.float32, copy=False) @ signs.T) / factors.astype(np.float32)[None, :]


def least_estimate(factors: np.ndarray, threshold: float) -> np.ndarray:
    """The confidence bound of each code, turned round: a pair with a smaller estimate is below the threshold for certain.

    The angle between q and c is at most that between q and o and that between o and c together, so that <o, q> >=
    threshold needs s >= cos(acos f + acos threshold).
    """
    angle = np.arccos(np.clip(factors, 0, 1)) + math.acos(max(-1.0, min(1.0, threshold)))
    return np.cos(np.minimum(angle, math.pi)) / factors - SLACK / factors


class Forest:
    """Union-find over row numbers; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.up, self.links = list(range(n)), []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.links.append((a, b))


def block_links(a: np.ndarray, b: np.ndarray | None, codes: np.ndarray, factors: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of a and b (None: of a with itself, i < j) with cosine >= threshold in double precision.

    codes and factors are those of b: pairs whose estimate reaches the bound are recomputed from the vectors.
    """
    inner = b is None
    b = a if inner else b
    turned, least = (units(a) @ rotation(a.shape[1])).astype(np.float32), least_estimate(factors, threshold)
    lengths = [np.linalg.norm(x, axis=1) for x in (a, b)]
    for i in range(0, len(a), TILE):
        for j in range(i if inner else 0, len(b), TILE):
            x, y = np.nonzero(estimates(turned[i : i + TILE], codes[j : j + TILE], factors[j : j + TILE]) >= least[None, j : j + TILE])
            x, y = x + i, y + j
            if inner:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), 65536):
                p, q = x[k : k + 65536], y[k : k + 65536]
                dots = np.einsum("ij,ij->i", a[p], b[q]) / (lengths[0][p] * lengths[1][q])
                if (hit := dots >= threshold).any():
                    yield p[hit], q[hit]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _codes(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, -(-dim // 8))


def _encoded(dealt: DataFrame) -> DataFrame:
    """The rows (rep, n, v and where they are) with code and factor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, factors = [b""] * batch.num_rows, np.zeros(batch.num_rows)
            dims = column(batch, "dim").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.nonzero(dims == dim)[0]
                packed, factors[at] = encode(units(_matrix(pa.chunked_array([column(batch, "v").take(pa.array(at))]), dim)), rotation(dim))
                for i, code in zip(at.tolist(), packed, strict=True):
                    codes[i] = code.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(factors)], names=[*batch.schema.names, "code", "factor"])

    kinds = ", ".join(f"{n} {t}" for n, t in dealt.dtypes)
    return map_batches(dealt, run, f"{kinds}, code binary, factor double")


def _meeting(coded: DataFrame, threshold: float, scanned: int) -> DataFrame:
    """(label, dim, i, j, rep): the vectors of blocks i and j, i <= j, that have an estimate in the other worth recomputing.

    A task has the vectors of one block and scans the codes of ``scanned`` others: a vector travels once for each that
    many blocks, only codes and factors to every block.
    """
    at = F.floor(F.col("block") / scanned).cast("int")
    last = F.floor((F.col("blocks") - 1) / scanned).cast("int")
    asks = coded.select("label", "dim", F.col("block").alias("i"), F.explode(F.sequence(at, last)).alias("part"), "block", "rep", "v", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("factor"))
    told = coded.select("label", "dim", F.explode(F.sequence(F.lit(0), "block")).alias("i"), at.alias("part"), "block", "rep", F.lit(None).cast("array<double>").alias("v"), "code", "factor")

    def scan(keys: tuple, t: pa.Table) -> pa.Table:
        _, dim, i, _ = (k.as_py() for k in keys)
        q, c = t.filter(pa.compute.is_valid(t["v"])), t.filter(pa.compute.is_valid(t["code"]))
        asking, telling, block = q["rep"].to_numpy(), c["rep"].to_numpy(), c["block"].to_numpy()
        out: list[tuple[int, np.ndarray]] = []
        if len(asking) and len(telling):
            turned = (units(_matrix(q["v"], dim)) @ rotation(dim)).astype(np.float32)
            codes, factors = _codes(c["code"], dim), c["factor"].to_numpy()
            least = least_estimate(factors, threshold)
            for j in np.unique(block).tolist():
                at = np.nonzero(block == j)[0]
                left, right = np.zeros(len(asking), dtype=bool), np.zeros(len(at), dtype=bool)
                for k in range(0, len(at), TILE):
                    some = at[k : k + TILE]
                    hit = estimates(turned, codes[some], factors[some]) >= least[None, some]
                    if j == i:
                        hit &= asking[:, None] != telling[None, some]
                    left |= hit.any(1)
                    right[k : k + TILE] |= hit.any(0)
                out.append((j, np.union1d(asking[left], telling[at[right]])))
        j = np.repeat(np.array([j for j, _ in out], dtype=np.int32), [len(r) for _, r in out])
        rep = np.concatenate([r for _, r in out]) if out else np.empty(0, dtype=np.int64)
        n = len(rep)
        return pa.table({"label": pa.array([keys[0].as_py()] * n, pa.string()), "dim": pa.array(np.full(n, dim), pa.int32()), "i": pa.array(np.full(n, i), pa.int32()), "j": pa.array(j), "rep": pa.array(rep, pa.int64())})

    return asks.unionByName(told).groupBy("label", "dim", "i", "part").applyInArrow(scan, "label string, dim int, i int, j int, rep long")


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK, scanned: int = SCANNED) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept. Vectors of one label link at cosine >= threshold.

    Null labels and ids, and vectors that are null, empty, zero or hold null or non-finite values link with nothing
    (component_id is the own id); so do vectors of different lengths. Rows that repeat an id are judged by their
    vectors, each for itself, and count as links of each other where these are near. Only id, vector and label are read; an empty table gives no
    rows.

    1. Equal vectors of a label are counted before anything moves and compared as one; each gets a binary code and its
    correction factor, written once. 2. The vectors of a block of about ``block`` are held against the codes of all
    blocks of their label; pairs of blocks in which no estimate reaches the bound are done with. 3. Of the others, the
    vectors concerned meet: pairs whose estimate reaches the bound are recomputed, links counted, and a spanning forest
    of them returned: never more rows than vectors, whatever the pairs. The bound is certain, so that no link is lost.
    """
    session_of(vectors)
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & (square > 0) & (square < F.lit(float("inf")))
    marked = base.select("vec_id", "label", F.when(good, F.col("v")).alias("v"))
    marked = written(marked.withColumn("vkey", F.when(F.col("v").isNotNull(), F.xxhash64("v"))))
    unique = marked.where("v is not null").groupBy("label", "vkey", "v").agg(F.min("vec_id").alias("who"), F.count("*").alias("n"))
    unique = written(unique.withColumn("rep", F.monotonically_increasing_id()))
    sizes = unique.groupBy("label", F.size("v").alias("dim")).agg(F.count("*").alias("_rows"))
    dealt = unique.withColumn("dim", F.size("v")).join(sizes, ["label", "dim"])
    count = F.ceil(F.col("_rows") / block).cast("int")
    dealt = dealt.withColumn("blocks", count).withColumn("block", F.pmod(F.xxhash64("rep"), count).cast("int"))
    coded = written(_encoded(dealt.select("label", "dim", "blocks", "block", "rep", "n", "v")))
    meeting = written(_meeting(coded, threshold, scanned))
    meet = meeting.join(coded.select("rep", "block", "n", "v", "code", "factor"), "rep")
    schema = T.StructType.fromDDL("rep long, links long, a long, b long")

    def compare(keys: tuple, t: pa.Table) -> pa.Table:
        _, dim, i, j = (k.as_py() for k in keys)
        v, codes, factors = _matrix(t["v"], dim), _codes(t["code"], dim), t["factor"].to_numpy()
        rep, n, own = (t.column(c).to_numpy() for c in ("rep", "n", "block"))
        links, forest = np.zeros(len(rep), dtype=np.int64), Forest(len(rep))
        left, right = np.nonzero(own == i)[0], np.nonzero(own == j)[0]
        pairs = block_links(v, None, codes, factors, threshold) if i == j else block_links(v[left], v[right], codes[right], factors[right], threshold)
        for p, q in pairs:
            p, q = (p, q) if i == j else (left[p], right[q])
            np.add.at(links, p, n[q])
            np.add.at(links, q, n[p])
            for x, y in zip(p.tolist(), q.tolist(), strict=True):
                forest.link(x, y)
        some = np.nonzero(links)[0]
        a, b = (np.array([pair[k] for pair in forest.links], dtype=np.int64) for k in (0, 1))
        none = lambda k: pa.nulls(k, pa.int64())
        cols = [(pa.array(rep[some]), none(len(a))), (pa.array(links[some]), none(len(a))), (none(len(some)), pa.array(rep[a])), (none(len(some)), pa.array(rep[b]))]
        return pa.table({name: pa.concat_arrays(list(c)) for name, c in zip(("rep", "links", "a", "b"), cols, strict=True)})

    found = written(meet.groupBy("label", "dim", "i", "j").applyInArrow(compare, schema))
    discard(meeting, coded)
    near = components(found.where("a is not null").select("a", "b"))
    least = near.join(unique.select("rep", "who"), F.col("node") == F.col("rep")).groupBy("component").agg(F.min("who").alias("least")).hint("rebalance")
    near = near.join(least, "component").select("node", "least")
    links = found.where("rep is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    groups = unique.join(links, "rep", "left").join(near, F.col("rep") == F.col("node"), "left")
    groups = groups.select("label", "vkey", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "who").alias("component_id"))
    # equal vectors only: the hash narrows the join, the vector decides
    groups = groups.select(F.col("label").alias("_l"), F.col("vkey").alias("_k"), F.col("v").alias("_v"), "n_links", "component_id")
    out = marked.join(groups, (F.col("label") == F.col("_l")) & (F.col("vkey") == F.col("_k")) & (F.col("v") == F.col("_v")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
comp AS (SELECT x, least(x, min(y)) AS c FROM reach GROUP BY x),
deg AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(vec_id = coalesce(c, vec_id), true) AS kept
FROM embeddings LEFT JOIN comp ON vec_id = comp.x LEFT JOIN deg ON vec_id = deg.x
"""
