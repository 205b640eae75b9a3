"""Readers of the catalogue's files: clips, record arrays, labels, vectors, manifests."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelmill.functions.expressions import clip_id, normal_label, parent_label, stem

SCORES = "path string, status string, mean_score double, frame_scores array<double>, time_s double"
MOTION = "path string, status string, flow_magnitude double, flow_variance double, ssim_mean double, motion_score double, time_s double"
CAPTIONS = "path string, status string, caption string, time_s double"
QUALITY = "path string, status string, caption string, clip_alignment double, caption_length int, specificity_score double, quality_score double, time_s double"
DEDUP = "kept array<string>, removed array<string>, exact_removed array<string>, threshold double, total long"


def clips(spark: SparkSession, folder: str, suffix: str = ".mp4") -> DataFrame:
    """Clips below a folder: path, length, content, label, stem. Contents are read only if they are used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(folder)
    return files.withColumn("label", parent_label("path")).withColumn("stem", stem("path"))


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON file that holds an array of records, or one object, in a fixed schema."""
    return spark.read.schema(StructType.fromDDL(schema)).option("multiLine", True).json(path)


def dedup_decisions(spark: SparkSession, path: str) -> DataFrame:
    """(path, decision) from a dedup result object."""
    found = records(spark, path, DEDUP)
    parts = [found.select(F.explode(c).alias("path"), F.lit(d).alias("decision")) for c, d in (("kept", "kept"), ("removed", "near_removed"), ("exact_removed", "exact_removed"))]
    return parts[0].union(parts[1]).union(parts[2])


def url_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> ''")


def label_lookup(spark: SparkSession, path: str) -> DataFrame:
    """(yt_id, label) of a CSV without header: two columns are needed, blanks become underscores, the last row of a key wins."""
    raw = spark.read.text(path, wholetext=False).select(F.from_csv("value", F.lit("label string, yt_id string")).alias("r"), F.struct(F.input_file_name(), F.monotonically_increasing_id()).alias("at"))
    rows = raw.select("r.label", F.trim("r.yt_id").alias("yt_id"), "at").where("yt_id is not null")
    return rows.groupBy("yt_id").agg(F.max_by("label", "at").alias("label")).select("yt_id", normal_label("label").alias("label"))


def with_label(clips_: DataFrame, lookup: DataFrame, name: str = "name") -> DataFrame:
    """Clips with ``label`` by the id in their name, unknown where there is none."""
    found = clips_.withColumn("yt_id", clip_id(name)).join(lookup.withColumnRenamed("label", "_label"), "yt_id", "left")
    return found.withColumn("label", F.coalesce("_label", F.lit("unknown"))).drop("_label")


def npz_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(path, mean_embedding, frame_embeddings) of the npz files of a folder; an empty folder is an error."""
    import numpy as np

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for path, content in zip(rows["path"], rows["content"], strict=True):
                with np.load(io.BytesIO(content)) as z:
                    name = str(z["video_path"].reshape(-1)[0]) if "video_path" in z else path
                    out.append((name, z["mean_embedding"].astype(float).tolist(), z["frame_embeddings"].astype(float).tolist() if "frame_embeddings" in z else None))
            yield pd.DataFrame(out, columns=["path", "mean_embedding", "frame_embeddings"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(folder)
    if files.select("path").isEmpty():
        raise FileNotFoundError(folder)
    return files.select("path", "content").mapInPandas(load, "path string, mean_embedding array<float>, frame_embeddings array<array<float>>")


def write_records(df: DataFrame, path: str) -> None:
    """A small result as a JSON array in one file; large ones belong in Parquet."""
    import json

    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    with store.open_output_stream(at) as out:
        out.write(json.dumps([json.loads(x) for x in df.toJSON().toLocalIterator()], indent=2).encode())
