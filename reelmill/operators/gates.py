"""Gates: which clips pass, why the others are skipped, and semi-joins with passing sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Usual thresholds of the aesthetic, motion and caption-quality gates.
MIN_SCORE, MIN_MOTION, MIN_QUALITY = 4.5, 5.0, 0.65


def at_least(x: Column, threshold: float) -> Column:
    """NaN and null fail."""
    return F.coalesce((x >= threshold) & ~F.isnan(x), F.lit(False))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of greatest ``order`` of each key: what a dictionary built in that order holds. Grouped before it moves."""
    return df.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct("*"), order).alias("_row")).select("_row.*")


def passing(df: DataFrame, column: str, threshold: float, need_ok: bool = True) -> DataFrame:
    """Paths whose value reaches the threshold; a missing value counts as 0."""
    ok = F.col("status") == "ok" if need_ok else F.lit(True)
    return df.where(ok & at_least(F.coalesce(F.col(column), F.lit(0.0)), threshold)).select("path").distinct()


def passing_all(clips: DataFrame, *sets: DataFrame | None) -> DataFrame:
    """Clips in every set; None is a gate that is off, an empty set lets nothing pass. Place it before a model step."""
    for s in sets:
        if s is not None:
            clips = clips.join(s.select("path"), "path", "left_semi")
    return clips


def gated(clips: DataFrame, scores: DataFrame, captions: DataFrame, motion: DataFrame | None = None, quality: DataFrame | None = None, min_score: float = MIN_SCORE, min_motion: float = MIN_MOTION, min_quality: float = MIN_QUALITY) -> DataFrame:
    """Clips with their signals and ``gate``: score, motion, quality, caption (the first that fails) or pass.

    A missing score is 0; a clip missing from a motion or quality table fails that gate, which is off without a table.
    Each table has one row a path; the joins are left ones that adaptive execution broadcasts where they are small.
    """
    out = clips.join(scores.select("path", "mean_score"), "path", "left")
    if motion is not None:
        out = out.join(motion.select("path", "motion_score"), "path", "left")
    if quality is not None:
        out = out.join(quality.select("path", "quality_score", "clip_alignment", "caption_length"), "path", "left")
    out = out.join(captions.where("status = 'ok'").select("path", "caption"), "path", "left")
    gate = F.when(~at_least(F.coalesce("mean_score", F.lit(0.0)), min_score), "score")
    if motion is not None:
        gate = gate.when(~at_least(F.col("motion_score"), min_motion), "motion")
    if quality is not None:
        gate = gate.when(~at_least(F.col("quality_score"), min_quality), "quality")
    gate = gate.when(F.coalesce("caption", F.lit("")) == "", "caption")
    return out.withColumn("gate", gate.otherwise("pass"))


def composition(gate_rows: DataFrame, by: str = "source") -> DataFrame:
    """Written and skipped clips by source."""
    count = lambda g: F.count_if(F.col("gate") == g)
    return gate_rows.groupBy(by).agg(count("pass").alias("total_written"), *[count(g).alias(f"skipped_{g}") for g in ("score", "motion", "quality", "caption")])


def kept_only(clips: DataFrame, kept: DataFrame | None, empty_keeps_all: bool = True) -> DataFrame:
    """Clips that dedup kept; no table, or by option an empty one, keeps all."""
    if kept is None or (empty_keeps_all and kept.isEmpty()):
        return clips
    return clips.join(kept.select("path"), "path", "left_semi")


def not_cached(clips: DataFrame, results: DataFrame, key: str = "path") -> DataFrame:
    """Clips without an ok result: failures are tried again."""
    return clips.join(results.where("status = 'ok'").select(key), key, "left_anti")


def with_cached(fresh: DataFrame, results: DataFrame) -> DataFrame:
    return fresh.unionByName(results.where("status = 'ok'"), allowMissingColumns=True)
