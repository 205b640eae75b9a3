"""Semantic filter: similarity to a query vector, threshold, inversion, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.expressions import dot, percent, unit


def similarities(vectors: DataFrame, query: list[float], vector_col: str = "v") -> DataFrame:
    """The rows with ``similarity``; the query is a literal, so nothing is joined."""
    return vectors.withColumn("similarity", dot(unit(vector_col), unit(F.array(*[F.lit(float(x)) for x in query]))))


def semantic_filter(vectors: DataFrame, query: list[float], threshold: float = 0.2, invert: bool = False, vector_col: str = "v") -> DataFrame:
    """Rows with ``similarity`` (4 digits) and ``kept``; a NaN similarity fails, inverted or not."""
    out = similarities(vectors, query, vector_col)
    passes = (F.col("similarity") >= threshold) != F.lit(invert)
    return out.withColumn("kept", F.coalesce(passes & ~F.isnan("similarity"), F.lit(False))).withColumn("similarity", F.round("similarity", 4))


def best(filtered: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    return filtered.where("kept").orderBy(F.desc("similarity"), id_col).limit(n)


def filter_summary(filtered: DataFrame) -> DataFrame:
    s = "similarity"
    return filtered.agg(F.count("*").alias("total"), F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("removed"), F.round(percent(F.count_if("kept"), F.count("*")), 1).alias("kept_pct"), *[F.round(f(s), 3).alias(f"sim_{n}") for n, f in (("mean", F.avg), ("median", F.median), ("max", F.max), ("min", F.min))])
