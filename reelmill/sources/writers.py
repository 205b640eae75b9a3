"""What the stages leave behind: one object as JSON, decisions, vectors and latents as files, cached results."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_object(row: DataFrame, path: str) -> None:
    """The one row of a summary as a JSON object in one file; maps and structs nest, nulls are written."""
    from pyarrow import fs

    text = row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("x")).first()["x"]
    store, at = fs.FileSystem.from_uri(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    with store.open_output_stream(at) as out:
        out.write(json.dumps(json.loads(text), indent=2).encode())


def dedup_result(exact: DataFrame, near: DataFrame, threshold: float) -> DataFrame:
    """One row: kept, removed, exact_removed (paths in order), threshold, total. near: path and kept of what exact kept."""
    paths = lambda rows, name: rows.agg(F.sort_array(F.collect_list("path")).alias(name))
    out = paths(near.where("kept"), "kept").crossJoin(paths(near.where("not kept"), "removed")).crossJoin(paths(exact.where("not kept"), "exact_removed"))
    return out.withColumn("threshold", F.lit(threshold)).crossJoin(exact.agg(F.count("*").alias("total")))


def filter_result(filtered: DataFrame, query: str, threshold: float, inverted: bool, name: str = "path") -> DataFrame:
    """One row: the query, total, kept (path and similarity, best first) and removed (paths in order)."""
    best = F.struct((-F.col("similarity")).alias("_o"), F.col(name).alias("path"), "similarity")
    kept = F.transform(F.sort_array(F.collect_list(F.when(F.col("kept"), best))), lambda x: F.struct(x["path"].alias("path"), x["similarity"].alias("similarity")))
    removed = F.sort_array(F.collect_list(F.when(~F.col("kept"), F.col(name))))
    out = filtered.agg(F.count("*").alias("total"), kept.alias("kept"), removed.alias("removed"))
    return out.select(F.lit(query).alias("query"), F.lit(threshold).alias("threshold"), F.lit(inverted).alias("inverted"), "total", "kept", "removed")


def stats_object(labels: DataFrame, totals: DataFrame, rare: DataFrame, **parts: DataFrame) -> DataFrame:
    """One row: clips by label, totals, rare labels, and a struct for each further summary, null where it has no row."""
    entries = F.sort_array(F.collect_list(F.struct("label", "clips")))
    out = labels.agg(F.map_from_entries(entries).alias("label_distribution")).crossJoin(totals)
    out = out.crossJoin(rare.agg(F.sort_array(F.collect_list("label")).alias("underrepresented_classes")))
    for name, part in parts.items():
        out = out.crossJoin(part.agg(F.first(F.struct("*")).alias(name)))
    return out


def _files(rows: DataFrame, folder: str, suffix: str, pack) -> DataFrame:
    """A file a row, named by ``stem``; (path, size_bytes) of each. A repeated attempt writes the same bytes again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                data, name = pack(row), f"{at}/{row['stem']}{suffix}"
                attempt = f"{at}/.{row['stem']}.{uuid.uuid4().hex}"
                with store.open_output_stream(attempt) as f:
                    f.write(data)
                if store.get_file_info(name).type != fs.FileType.NotFound:
                    store.delete_file(name)
                store.move(attempt, name)
                out.append((name, len(data)))
            yield pd.DataFrame(out, columns=["path", "size_bytes"])

    return rows.mapInPandas(run, "path string, size_bytes long")


def write_npz(vectors: DataFrame, folder: str) -> DataFrame:
    """(stem, path, mean_embedding, frame_embeddings) -> ``<stem>.npz`` files in single precision."""

    def pack(row: dict) -> bytes:
        out = io.BytesIO()
        frames = np.asarray([np.asarray(f, dtype="<f4") for f in row["frame_embeddings"]], dtype="<f4")
        np.savez(out, mean_embedding=np.asarray(row["mean_embedding"], dtype="<f4"), frame_embeddings=frames, video_path=np.array([row["path"]]))
        return out.getvalue()

    return _files(vectors.select("stem", "path", "mean_embedding", "frame_embeddings"), folder, ".npz", pack)


def write_latents(latents: DataFrame, folder: str) -> DataFrame:
    """(stem, shape, data) -> ``<stem>.npy`` files of half precision."""

    def pack(row: dict) -> bytes:
        out = io.BytesIO()
        np.save(out, np.frombuffer(row["data"], dtype="<f2").reshape(list(row["shape"])))
        return out.getvalue()

    return _files(latents.select("stem", "shape", "data"), folder, ".npy", pack)


def append_results(fresh: DataFrame, path: str) -> None:
    """Adds ok rows to the results table at a path; failures are left out, so that the next run tries them again."""
    fresh.where("status = 'ok'").write.mode("append").parquet(path)


def cached_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The results table, or no rows where none has been written; of a clip that is there twice, one row."""
    from pyspark.errors import AnalysisException

    try:
        found = spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return found.dropDuplicates(["path"])


def write_by_label(clips: DataFrame, path: str) -> None:
    """Extracted clips as a table in folders by label."""
    clips.write.mode("append").partitionBy("label").parquet(path)
