"""Summaries: labels, scores, captions, motion, histograms, vector means, principal components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from reelmill.functions.expressions import bin_of, motion_score, percent, status_class


def label_distribution(clips: DataFrame, label: str = "label") -> DataFrame:
    return clips.groupBy(label).agg(F.count("*").alias("clips"))


def top_labels(clips: DataFrame, n: int = 30, label: str = "label") -> DataFrame:
    """The n labels with most clips, ties by label."""
    return label_distribution(clips, label).orderBy(F.desc("clips"), label).limit(n)


def class_totals(clips: DataFrame, label: str = "label") -> DataFrame:
    """n_classes and total_clips; a null label is no class."""
    found = label_distribution(clips, label)
    return found.agg(F.count(label).alias("n_classes"), F.coalesce(F.sum("clips"), F.lit(0)).alias("total_clips"))


def throughput(results: DataFrame, begin: Column, end: Column) -> DataFrame:
    """Rows a second between the least begin and the greatest end (seconds), null without time between them."""
    took = F.max(end) - F.min(begin)
    return results.agg(F.count("*").alias("clips"), F.round(took, 3).alias("seconds"), F.when(took > 0, F.round(F.count("*") / took, 3)).alias("clips_per_s"))


def first_paths(clips: DataFrame, n: int) -> DataFrame:
    """The first n clips in order of folder and file name."""
    return clips.orderBy(F.regexp_replace("path", "[^/]*$", ""), F.regexp_extract("path", "[^/]*$", 0)).limit(n)


def metrics(run: str, stage: str, summary_row: DataFrame) -> DataFrame:
    """A summary of one row as rows (run, stage, metric, value); texts are left out."""
    numbers = [c for c, t in summary_row.dtypes if t in ("int", "bigint", "double", "float")]
    wide = summary_row.select(*[F.col(c).cast("double").alias(c) for c in numbers])
    return wide.unpivot([], numbers, "metric", "value").select(F.lit(run).alias("run"), F.lit(stage).alias("stage"), "metric", "value")


def rare_labels(clips: DataFrame, min_clips: int = 10, label: str = "label") -> DataFrame:
    return label_distribution(clips, label).where(F.col("clips") < min_clips)


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy(status_class("status").alias("status")).agg(F.count("*").alias("n"))


def summary(x: str, digits: int = 3) -> list[Column]:
    """Mean, exact median, population deviation, least and greatest.

    The median is one of values of four digits, as the signals have: what it counts is bounded by their range, not by
    the rows.
    """
    found = {"mean": F.avg(x), "median": F.median(F.round(x, 4)), "std": F.stddev_pop(x), "min": F.min(x), "max": F.max(x)}
    return [F.round(c, digits).alias(k) for k, c in found.items()]


def score_summary(scores: DataFrame, thresholds: tuple[float, ...] = (4.5, 5.0)) -> DataFrame:
    """One row over ok scores; none if there is none."""
    shares = [F.round(percent(F.count_if(F.col("mean_score") >= t), F.count("*")), 1).alias(f"pct_{str(t).replace('.', '_')}") for t in thresholds]
    return scores.where("status = 'ok'").agg(F.count("*").alias("n"), *summary("mean_score"), *shares).where("n > 0")


def histogram(df: DataFrame, x: str, bins: int = 40) -> DataFrame:
    """Rows a bin; empty bins are left out."""
    edges = df.agg(F.min(x).alias("_low"), F.max(x).alias("_high"))
    return df.select(x).crossJoin(F.broadcast(edges)).groupBy(bin_of(x, F.col("_low"), F.col("_high"), bins).alias("bin")).agg(F.count("*").alias("n"))


def caption_coverage(clips: DataFrame, captions: DataFrame) -> DataFrame:
    """Captioned clips among all clips, and captions that are empty or failed."""
    ok = F.col("status") == "ok"
    found = captions.agg(F.count_if(ok & (F.col("caption") != "")).alias("captioned"), F.count_if(ok & (F.col("caption") == "")).alias("empty"), F.count_if(~ok).alias("failed"))
    total = clips.agg(F.count("*").alias("total_videos"))
    return total.crossJoin(found).withColumn("coverage_pct", F.round(percent(F.col("captioned"), F.col("total_videos")), 1))


def motion_pairs(frames: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Neighbouring frames of a clip: each row with the one before, the first one left out."""
    w = W.partitionBy(key).orderBy(*order)
    return frames.withColumn("before", F.lag(value).over(w)).where("before is not null")


def motion_scores(pairs: DataFrame, key: str = "path") -> DataFrame:
    """(key, flow, ssim) a pair -> mean flow, its population variance, mean ssim and the score, 4 digits each."""
    found = pairs.groupBy(key).agg(F.avg("flow").alias("m"), F.var_pop("flow").alias("v"), F.avg("ssim").alias("s"))
    score = motion_score("m", "v", "s")
    rounded = {"flow_magnitude": F.col("m"), "flow_variance": F.col("v"), "ssim_mean": F.col("s"), "motion_score": score}
    return found.select(key, F.lit("ok").alias("status"), *[F.round(c, 4).alias(n) for n, c in rounded.items()])


def mean_pool(frames: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, place, mean): the mean vector of a group over its length plus 1e-8, a row a dimension."""
    means = frames.select(key, F.posexplode(vector).alias("place", "x")).groupBy(key, "place").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    length = F.sqrt(F.sum(F.col("mean") * F.col("mean")).over(W.partitionBy(key))) + 1e-8
    return means.select(key, F.col("place").cast("long").alias("place"), (F.col("mean") / length).alias("mean"))


def principal_shares(vectors: DataFrame, vector: str, k: int = 2) -> DataFrame:
    """(component, share): explained variance of the first k principal components."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vectors.select(array_to_vector(F.col(vector).cast("array<double>")).alias("_v")))
    return vectors.sparkSession.createDataFrame([(i + 1, float(x)) for i, x in enumerate(model.explainedVariance)], "component int, share double")


def principal_points(vectors: DataFrame, id_col: str, vector: str, limit: int = 2000) -> DataFrame:
    """(id, x, y): the first ``limit`` vectors in id order on their two principal axes, less their mean; signs are free."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = vectors.where(F.col(vector).isNotNull()).orderBy(id_col).limit(limit)
    rows = rows.select(F.col(id_col).alias("id"), array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    out = PCA(k=2, inputCol="_v", outputCol="_p").fit(rows).transform(rows).select("id", vector_to_array("_p").alias("_p"))
    mean = out.agg(F.avg(F.col("_p")[0]).alias("_x"), F.avg(F.col("_p")[1]).alias("_y"))
    return out.crossJoin(F.broadcast(mean)).select("id", (F.col("_p")[0] - F.col("_x")).alias("x"), (F.col("_p")[1] - F.col("_y")).alias("y"))


def dense_label_index(clips: DataFrame, label: str = "label") -> DataFrame:
    """(label, index): distinct labels numbered in order; the table has a row a label."""
    return clips.select(label).distinct().withColumn("index", F.dense_rank().over(W.orderBy(label)) - 1)
