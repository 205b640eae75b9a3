"""Shards: contiguous numbering, sample metadata, tar files written and counted."""

from __future__ import annotations

import io
import re
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from reelmill.functions.expressions import megabytes, shard_file, shard_key, stem

from .tables import written


def numbered(df: DataFrame, order: str) -> DataFrame:
    """Rows with ``ordinal`` from 0 in order of a unique column, without one task that sorts them all.

    The rows are written in ascending ranges; a range's start is the number of rows before it (a row a range), a row's
    place in it a window over the range.
    """
    ranges = written(df.repartitionByRange(F.col(order)).withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    start = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(W.partitionBy("_range").orderBy(order)) - 1
    out = ranges.withColumn("_place", place).join(counts.select("_range", start.alias("_start")), "_range")
    return out.withColumn("ordinal", F.col("_start") + F.col("_place")).drop("_range", "_place", "_start")


def assigned(samples: DataFrame, size: int = 200, order: str = "path") -> DataFrame:
    """Samples with ordinal, shard_idx, position, a key that is unique over all shards, and the shard's file name."""
    out = numbered(samples, order).withColumn("shard_idx", F.floor(F.col("ordinal") / size).cast("long")).withColumn("position", F.col("ordinal") % size)
    return out.withColumn("key", shard_key("shard_idx", "position")).withColumn("shard", shard_file("shard_idx"))


def metadata(samples: DataFrame, columns: list[str]) -> DataFrame:
    """Samples with ``json``: the columns as an object, nulls written out."""
    return samples.withColumn("json", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def write_tars(samples: DataFrame, folder: str, members: dict[str, str]) -> DataFrame:
    """One tar a shard: for each sample ``<key>.<suffix>`` from a column, left out where it is null.

    Returns a row a shard: shard, size_bytes, samples. A task reads its shards' samples in order and appends each to the
    open tar, so that it holds a batch of them at a time. Files go through the file system of the folder's URI by a name
    of the attempt first; a task that is run again finds the shard there and leaves it.
    """
    columns = list(dict.fromkeys(["shard", "position", "key", *members.values()]))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        shard, tar, out, attempt, count = None, None, None, "", 0

        def close() -> pd.DataFrame:
            tar.close()
            out.close()
            if store.get_file_info(f"{at}/{shard}").type == fs.FileType.NotFound:
                store.move(attempt, f"{at}/{shard}")
            else:
                store.delete_file(attempt)
            return pd.DataFrame([(shard, store.get_file_info(f"{at}/{shard}").size, count)], columns=["shard", "size_bytes", "samples"])

        for rows in batches:
            for row in rows.to_dict("records"):
                if row["shard"] != shard:
                    if tar:
                        yield close()
                    shard, attempt, count = row["shard"], f"{at}/.{row['shard']}.{uuid.uuid4().hex}", 0
                    out = store.open_output_stream(attempt)
                    tar = tarfile.open(fileobj=out, mode="w|")
                count += 1
                for suffix, column in members.items():
                    if (data := row[column]) is not None:
                        data = data.encode() if isinstance(data, str) else bytes(data)
                        info = tarfile.TarInfo(f"{row['key']}.{suffix}")
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
        if tar:
            yield close()

    dealt = samples.select(*columns).repartition("shard").sortWithinPartitions("shard", "position")
    return dealt.mapInPandas(pack, "shard string, size_bytes long, samples long")


def _opened(path: str):
    """The file system that a URI of Spark's names, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def tar_members(files: DataFrame, suffix: str = "") -> DataFrame:
    """Rows with a path -> (path, name, size, data) of the tar's members with the suffix, folders stripped.

    The tar, compressed or not, is read as a stream, a member at a time; a damaged one gives none.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for path in rows["path"]:
                store, at = _opened(path)
                try:
                    with store.open_input_stream(at, compression=None) as f, tarfile.open(fileobj=f, mode="r|*") as tar:
                        for m in tar:
                            if m.isfile() and m.name.endswith(suffix):
                                yield pd.DataFrame([(path, m.name.rpartition("/")[2], m.size, tar.extractfile(m).read())], columns=["path", "name", "size", "data"])
                except (tarfile.TarError, EOFError, OSError):
                    continue

    return files.select("path").mapInPandas(read, "path string, name string, size long, data binary")


def shard_files(files: DataFrame, suffix: str = ".mp4") -> DataFrame:
    """Rows with path and length of tars -> name, size_bytes, samples; only members' headers are read, damaged tars have 0."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for path, length in zip(rows["path"], rows["length"], strict=True):
                store, at = _opened(path)
                try:
                    with store.open_input_file(at) as f, tarfile.open(fileobj=f, mode="r:") as tar:
                        n = sum(m.name.endswith(suffix) for m in tar)
                except (tarfile.TarError, EOFError, OSError):
                    n = 0
                out.append((path.rpartition("/")[2], length, n))
            yield pd.DataFrame(out, columns=["name", "size_bytes", "samples"])

    return files.select("path", "length").mapInPandas(count, "name string, size_bytes long, samples long")


def shard_stats(files: DataFrame) -> DataFrame:
    """Rows with path and length of tars -> count, samples, bytes, MB over all, and the files in order of their names."""
    total = F.coalesce(F.sum("size_bytes"), F.lit(0))
    found = F.sort_array(F.collect_list(F.struct("name", "size_bytes", "samples"))).alias("files")
    out = shard_files(files).agg(F.count("*").alias("count"), F.coalesce(F.sum("samples"), F.lit(0)).alias("total_samples"), total.alias("total_bytes"), found)
    return out.withColumn("total_mb", megabytes("total_bytes")).select("count", "total_samples", "total_bytes", "total_mb", "files")


def labelled_clips(tars: DataFrame, lookup: DataFrame, suffix: str = ".mp4") -> DataFrame:
    """Clips of downloaded archives with the label of the id in their name: path, name, yt_id, label, data."""
    from reelmill.sources.readers import with_label

    return with_label(tar_members(tars, suffix), lookup).select("path", "name", "yt_id", "label", "data")


def with_latents(samples: DataFrame, latents: DataFrame) -> DataFrame:
    """Samples with ``latent``, the bytes of the row of the same stem, null where there is none."""
    found = latents.select(F.col("stem").alias("_stem"), F.col("data").alias("latent"))
    return samples.join(found, stem("path") == F.col("_stem"), "left").drop("_stem")
