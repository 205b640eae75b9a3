"""Manifests: one nested row over all signals, and the change between two of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.expressions import delta_text


def signal(df: DataFrame, column: str, threshold: float, prefix: str) -> DataFrame:
    """scored, passing and the mean (3 digits, 0 without rows) over ok rows."""
    ok = df.where("status = 'ok'")
    return ok.agg(F.count("*").alias(f"{prefix}_scored"), F.count_if((F.col(column) >= threshold) & ~F.isnan(column)).alias(f"{prefix}_passing"), F.round(F.coalesce(F.avg(column), F.lit(0.0)), 3).alias(f"{prefix}_mean"))


def manifest(version: str, clips: DataFrame, dedup: DataFrame, scores: DataFrame, motion: DataFrame | None, quality: DataFrame | None, min_score: float = 4.5, min_motion: float = 5.0, min_quality: float = 0.65) -> DataFrame:
    """One flat row: counts of each signal for itself, as each stage reports them. Tables that are None are left out."""
    parts = [clips.agg(F.count("*").alias("total_videos")), dedup.agg(F.count_if("kept").alias("dedup_kept"), F.count_if(~F.col("kept")).alias("dedup_removed")), signal(scores, "mean_score", min_score, "score")]
    if motion is not None:
        parts.append(signal(motion, "motion_score", min_motion, "motion"))
    if quality is not None:
        parts.append(signal(quality, "quality_score", min_quality, "quality"))
        parts.append(quality.where("status = 'ok'").agg(F.round(F.coalesce(F.avg("clip_alignment"), F.lit(0.0)), 3).alias("mean_clip_alignment")))
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # each is one row
    return out.select(F.lit(version).alias("version"), "*")


def diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(metric, a, b, delta): full outer on the metric; no delta unless both have it."""
    long = lambda m, name: m.unpivot(["version"], [c for c in m.columns if c != "version"], "metric", name).select("metric", F.col(name).cast("double").alias(name))
    return long(a, "a").join(long(b, "b"), "metric", "full").select("metric", "a", "b", delta_text("a", "b").alias("delta"))


#: What a manifest file holds.
DOCUMENT = (
    "version string, created_at string, config map<string,string>, sources struct<video_dir:string,total_videos:long>, "
    "dedup struct<total:long,kept:long,removed:long,threshold:double>, scoring struct<scored:long,passing:long,mean:double,min_score_threshold:double>, "
    "motion struct<scored:long,passing:long,mean:double,min_motion_threshold:double>, "
    "caption_quality struct<scored:long,passing:long,mean_quality:double,mean_clip_alignment:double,min_quality_threshold:double>, "
    "shards struct<count:long,total_samples:long,total_bytes:long,total_mb:double,files:array<struct<name:string,size_bytes:long,samples:long>>>"
)


def document(flat: DataFrame, shards: DataFrame, created_at: str, video_dir: str, config: dict[str, str], thresholds: dict[str, float]) -> DataFrame:
    """The nested row of a manifest from its flat one and the shards' statistics; a signal that was left out is null."""
    has = set(flat.columns)
    n = lambda c: F.col(c).cast("long")
    at = lambda k: F.lit(thresholds.get(k)).cast("double")

    def part(prefix: str, key: str, mean: str, *more) -> object:
        if f"{prefix}_scored" not in has:
            return F.lit(None)
        return F.struct(n(f"{prefix}_scored").alias("scored"), n(f"{prefix}_passing").alias("passing"), F.col(f"{prefix}_mean").alias(mean), *more, at(key).alias(f"{key}_threshold"))

    alignment = F.col("mean_clip_alignment").alias("mean_clip_alignment") if "mean_clip_alignment" in has else F.lit(None).cast("double").alias("mean_clip_alignment")
    pairs = [F.lit(x) for kv in config.items() for x in kv]
    return flat.crossJoin(shards.select(F.struct("*").alias("_shards"))).select(
        "version", F.lit(created_at).alias("created_at"), (F.create_map(*pairs) if pairs else F.expr("map()")).cast("map<string,string>").alias("config"),
        F.struct(F.lit(video_dir).alias("video_dir"), n("total_videos").alias("total_videos")).alias("sources"),
        F.struct(n("total_videos").alias("total"), n("dedup_kept").alias("kept"), n("dedup_removed").alias("removed"), at("dedup").alias("threshold")).alias("dedup"),
        part("score", "min_score", "mean").alias("scoring"), part("motion", "min_motion", "mean").alias("motion"),
        part("quality", "min_quality", "mean_quality", alignment).alias("caption_quality"), F.col("_shards").alias("shards"),
    )


def listed(documents: DataFrame) -> DataFrame:
    """A line a manifest: version, created (to the second), videos, kept, shards, size in MB."""
    return documents.select("version", F.substring("created_at", 1, 19).alias("created"), F.col("sources.total_videos").alias("videos"), F.col("dedup.kept").alias("kept"), F.col("shards.count").alias("shards"), F.col("shards.total_mb").alias("size_mb"))


def flat_of(documents: DataFrame) -> DataFrame:
    """The numbers of manifest documents side by side, as ``diff`` takes them."""
    numbers = {
        "total_videos": "sources.total_videos", "dedup_kept": "dedup.kept", "dedup_threshold": "dedup.threshold", "score_passing": "scoring.passing", "min_score": "scoring.min_score_threshold",
        "motion_passing": "motion.passing", "min_motion": "motion.min_motion_threshold", "quality_passing": "caption_quality.passing", "min_quality": "caption_quality.min_quality_threshold",
        "shards": "shards.count", "total_samples": "shards.total_samples", "total_mb": "shards.total_mb",
    }
    return documents.select("version", *[F.col(c).cast("double").alias(k) for k, c in numbers.items()])


def report(rows: DataFrame) -> list[str]:
    """The rows of a small result as lines of text, columns aligned; missing values show as ?."""
    found = [[c for c in rows.columns]] + [["?" if x is None else str(x) for x in r] for r in rows.collect()]
    widths = [max(len(r[i]) for r in found) for i in range(len(rows.columns))]
    return ["  ".join(x.ljust(w) for x, w in zip(r, widths, strict=True)).rstrip() for r in found]
