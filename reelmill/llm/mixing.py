"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import written

#: Weights of the sources in code-point order, repeating; the most often that a source may be taken; the seed.
WEIGHTS, MAX_EPOCHS, SEED = (5, 2, 1), 3, 17
#: Words: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Hash parts of each size class of a source, so that no class of equal sizes is one task.
PARTS = 64


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash32(*parts: Column) -> Column:
    """The first 32 bits of an md5, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def water_filled(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target``: the total shared by weight, no source above epochs * size.

    Sources rank by code point, null last, and weigh ``weights[rank % len]``. With the sources in order of cap per
    weight, those before the first whose cap holds its share of what is left are clamped; the rest share by weight.
    The table has one row a source, and two windows over it.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")).cast("long")
    capped = sizes.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * epochs)
    by_cap = W.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    every = by_cap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    share = left.cast("double") / (F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
    shared = capped.withColumn("_share", share).withColumn("_order", F.row_number().over(by_cap))
    holds = F.when(F.col("_cap") >= F.col("_weight") * F.col("_share"), F.struct("_order", "_share"))
    level = F.min(holds).over(W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    filled = shared.withColumn("_level", level)
    clamped = F.col("_level").isNull() | (F.col("_order") < F.col("_level._order"))
    target = F.when(clamped, F.col("_cap").cast("double")).otherwise(F.col("_weight") * F.col("_level._share"))
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, ``repeats`` (how often the mix takes it), and the columns to carry.

    A source at rate target / source_size takes each document floor(rate) times, and a seeded systematic sample of its
    documents once more: in order of size class, part and size, the document at which position * fraction + offset
    passes a whole number. Sizes follow each other in order, so the words taken stay near the target. Null text has
    size 0, as has text of white space; null sources are one source, the last; a null id counts as the empty text in
    the hash and repeated ids are ordered by size alone (equal rows are alike); an empty table gives no rows. A source
    of size 0 has target 0 and takes nothing. Only id, text and source are read.

    Positions come from counts of (source, size class, part), at most some thousands for a source whatever its rows,
    plus a row number within each such group.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    hashed = hash32(F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digits = F.col("_size").cast("string")
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c_{c}") for c in carry], F.col(id_col).alias("_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("_size"), hashed.alias("_hash"))
    rows = rows.withColumn("_key", key).withColumn("_grade", F.length(digits) * 10 + F.substring(digits, 1, 1).cast("int")).withColumn("_part", F.col("_hash") % PARTS)
    sized = written(rows.select("_id", "source", "_size", "_key", "_grade", "_part", "_hash"))
    rows = rows if carry else sized
    sources = water_filled(sized.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, epochs)
    offset = hash32(F.lit(str(seed)), F.lit("source"), key) / F.lit(2.0**32)
    sources = sources.select(key.alias("_key"), "source_size", "target", offset.alias("_offset"))
    group = ["_key", "_grade", "_part"]
    counts = sized.groupBy(*group).agg(F.count("*").alias("_n"))
    ahead = F.sum("_n").over(W.partitionBy("_key").orderBy("_grade", "_part").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select(*group, F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    place = F.row_number().over(W.partitionBy(*group).orderBy("_size", "_hash", "_id"))
    placed = rows.withColumn("_place", place).join(counts, group).join(sources, "_key")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    k, fraction = F.col("_ahead") + F.col("_place"), rate - F.floor(rate)
    once_more = F.floor(k * fraction + F.col("_offset")) - F.floor((k - 1) * fraction + F.col("_offset"))
    repeats = (F.floor(rate) + once_more).cast("long")
    mixed = [F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * repeats).alias("taken"), repeats.alias("repeats")]
    return placed.select(*mixed, *[F.col(f"`c_{c}`") for c in carry])


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each document's row as often as it is taken, with the columns of the input."""
    out = mix(docs, carry=tuple(docs.columns), **how).where("repeats > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
    return out.select(*[F.col(f"`c_{c}`").alias(c) for c in docs.columns])


ORACLE_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         coalesce('s' || source, 'n') AS k,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM documents),
graded AS (SELECT *, length(size::VARCHAR) * 10 + substr(size::VARCHAR, 1, 1)::INT AS grade, h % {PARTS} AS part FROM sized),
sums AS (SELECT source, k, sum(size)::BIGINT AS source_size FROM sized GROUP BY ALL),
weighed AS (SELECT *, ([{", ".join(map(str, WEIGHTS))}])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}]::BIGINT AS w FROM sums),
shares AS (
  SELECT *, {MAX_EPOCHS} * source_size AS cap, row_number() OVER o AS pos,
    (sum(source_size) OVER ()::BIGINT - coalesce(sum({MAX_EPOCHS} * source_size) OVER b, 0)::BIGINT)::DOUBLE
    / (sum(w) OVER ()::BIGINT - coalesce(sum(w) OVER b, 0)::BIGINT) AS share
  FROM weighed
  WINDOW o AS (ORDER BY ({MAX_EPOCHS} * source_size)::DOUBLE / w, source NULLS LAST),
         b AS (ORDER BY ({MAX_EPOCHS} * source_size)::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT min(pos) AS pos, arg_min(share, pos) AS share FROM shares WHERE cap >= w * share),
targets AS (
  SELECT k, source_size, CASE WHEN level.pos IS NULL OR shares.pos < level.pos THEN cap::DOUBLE ELSE w * level.share END AS target,
    ('0x' || substr(md5('{SEED}:source:' || k), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM shares CROSS JOIN level),
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY grade, part, size, h, doc_id) AS i FROM graded),
rated AS (SELECT doc_id, size, source_size, target, u, i, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM placed JOIN targets USING (k)),
times AS (SELECT *, (floor(rate) + floor(i * (rate - floor(rate)) + u) - floor((i - 1) * (rate - floor(rate)) + u))::BIGINT AS repeats FROM rated)
SELECT doc_id, size, source_size, target, size * repeats AS taken, repeats FROM times
"""
