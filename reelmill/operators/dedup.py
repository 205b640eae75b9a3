"""Exact and near duplicates of clips."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from reelmill.functions.expressions import unit

from .tables import written

#: Neighbours of a vector that count, itself included; vectors of a block; usual threshold.
NEIGHBOURS, BLOCK, THRESHOLD = 50, 1024, 0.95


def exact_dedup(clips: DataFrame, cache: DataFrame | None = None, content: str = "content") -> DataFrame:
    """path, md5, kept: the first path of each content hash is kept. A cache of (path, md5) saves reading known clips.

    The least path of a hash is a pre-aggregated minimum, so copies of one clip are no hot task. A null content has no
    hash and is kept.
    """
    if cache is None:
        hashed = clips.select("path", F.md5(F.col(content).cast("binary")).alias("md5"))
    else:
        known = cache.select("path", "md5")
        fresh = clips.join(known, "path", "left_anti").select("path", F.md5(F.col(content).cast("binary")).alias("md5"))
        hashed = fresh.unionByName(known.join(clips.select("path"), "path", "left_semi"))
    first = hashed.groupBy("md5").agg(F.min("path").alias("first")).withColumnRenamed("md5", "_md5")
    out = hashed.join(first, F.col("md5") == F.col("_md5"), "left")
    return out.select("path", "md5", (F.col("md5").isNull() | (F.col("path") == F.col("first"))).alias("kept"))


def _nearest(sims: np.ndarray, threshold: float | None, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest of each row, ties by id, at or above the threshold."""
    least = np.full(len(sims), -np.inf if threshold is None else threshold)
    if sims.shape[1] > k:
        least = np.maximum(least, np.partition(sims, -k, axis=1)[:, -k])
    x, y = np.nonzero(sims >= least[:, None])
    order = np.lexsort((ids[y], -sims[x, y], x))
    x, y = x[order], y[order]
    place = np.arange(len(x)) - np.searchsorted(x, x)
    return x[place < k], y[place < k]


def neighbours(vectors: DataFrame, threshold: float | None = None, k: int = NEIGHBOURS, id_col: str = "id", vector_col: str = "v", block: int = BLOCK) -> DataFrame:
    """(id, other, sim): the k nearest vectors of each by inner product of unit vectors, itself included, ties by id.

    Hash blocks of about ``block`` vectors meet in pairs, each pair once, and multiply as matrices; a task holds two
    blocks and returns k rows a vector at most. A threshold is applied before the rank: what lies below it cannot
    displace what lies above. Nearest neighbours need every pair's product, so work grows with the square of the rows.
    """
    units = written(vectors.select(F.col(id_col).cast("long").alias("id"), unit(vector_col).alias("v")).where("id is not null and v is not null"))
    count = units.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("int").alias("blocks"))
    placed = units.crossJoin(F.broadcast(count)).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    meet = placed.select("own", other, "id", "v").select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "v")

    def multiply(keys: tuple, t: pa.Table) -> pa.Table:
        i, j = (x.as_py() for x in keys)
        ids, own = t["id"].to_numpy(), t["own"].to_numpy()
        lists = t["v"].combine_chunks()
        v = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        left, right = np.nonzero(own == i)[0], np.nonzero(own == j)[0]
        found = [np.empty((0,), dtype=np.int64)] * 2 + [np.empty(0)]
        if len(left) and len(right):
            sims = v[left] @ v[right].T
            x, y = _nearest(sims, threshold, k, ids[right])
            found = [ids[left][x], ids[right][y], sims[x, y]]
            if i != j:
                y, x = _nearest(sims.T, threshold, k, ids[left])
                found = [np.concatenate(p) for p in zip(found, [ids[right][y], ids[left][x], sims[x, y]], strict=True)]
        return pa.table(dict(zip(("id", "other", "sim"), map(pa.array, found), strict=True)))

    near = meet.groupBy("i", "j").applyInArrow(multiply, "id long, other long, sim double")
    best = F.row_number().over(W.partitionBy("id").orderBy(F.desc("sim"), "other"))
    return near.withColumn("_rank", best).where(f"_rank <= {k}").drop("_rank")


def near_pairs(vectors: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS, **columns) -> DataFrame:
    """(a, b, sim), a < b: pairs at or above the threshold of which one is among the other's k nearest."""
    found = neighbours(vectors, threshold, k, **columns).where("id <> other")
    return found.groupBy(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).agg(F.max("sim").alias("sim"))


def components(nodes: DataFrame, pairs: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(id, component) of all nodes: the least id that pairs (a, b) reach. Labels spread and jump until nothing changes."""
    edges = written(pairs.selectExpr("a as id", "b as other").union(pairs.selectExpr("b", "a")).distinct())
    labels = written(edges.groupBy("id").agg(F.min("other").alias("least")).select("id", F.least("id", "least").alias("component")))
    for _ in range(max_rounds):
        seen = edges.join(labels.select(F.col("id").alias("other"), "component"), "other").groupBy("id").agg(F.min("component").alias("near"))
        better = labels.join(seen, "id").select("id", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("component").alias("beyond"))
        stepped = written(better.join(jump, "next", "left").select("id", "component", F.least("next", F.coalesce("beyond", "next")).alias("next")))
        labels = stepped.select("id", F.col("next").alias("component"))
        if stepped.where("next < component").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return nodes.select("id").join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def near_dedup(vectors: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS, id_col: str = "id", vector_col: str = "v") -> DataFrame:
    """(id, component, kept): of each component the first vector in id order is kept."""
    found = components(vectors.select(F.col(id_col).alias("id")), near_pairs(vectors, threshold, k, id_col=id_col, vector_col=vector_col))
    return found.withColumn("kept", F.col("id") == F.col("component"))
