"""Shared helpers: inputs, the shared folder for written tables, ordered partitions, batch loops."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch sent to Python at most (one longer row is a batch of its own).
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def session_of(df: DataFrame) -> SparkSession:
    """The frame's session, whose Arrow batches are made small where they are larger: long texts must not meet in one."""
    spark = df.sparkSession
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(key).rstrip("b"))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder; one in fewer parts than there are cores is dealt out first."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; only where that is unset and Spark is one process, a local one."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="reelmill-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/reelmill-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing to come reads: what was made of them has been written itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from every training set: crc32 of the id as text, modulo 5, is 0 (a null id never)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def map_batches(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    session_of(df)
    return df.mapInArrow(rows, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ordered_parts(df: DataFrame, key: str, n: int | None = None) -> tuple[DataFrame, list[int]]:
    """Rows with ``_part``, the ascending range of ``key`` (a non-null long) that holds them, and the range bounds.

    The bounds come from the key column alone (at most n of them reach the driver), so that the wide columns are read
    once, when the rows move.
    """
    n = n or partitions(session_of(df))
    bounds = sorted({int(x) for x in df.approxQuantile(key, [i / n for i in range(1, n)], 0.2 / n)} if n > 1 else [])
    cuts = np.asarray(bounds, dtype="int64")

    @F.pandas_udf("int")
    def part(x):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, x.to_numpy(), side="right").astype("int32"))

    return df.withColumn("_part", part(F.col(key))), bounds


class Pieces(dict):
    """Numbers distinct pieces of texts in order of appearance."""

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        return n


def split_batch(texts: Iterable[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct runs without blanks in some texts, the run at each place, and where each text's places end."""
    known, places, ends = Pieces(), [], [0]
    for text in texts:
        places.extend(map(known.__getitem__, (text or "").split()))
        ends.append(len(places))
    return list(known), np.array(places, dtype=np.int64), np.array(ends)


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows between neighbouring ends."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[ends[1:]] - total[ends[:-1]]


def hash64(text: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text)


def crc(text: bytes) -> int:
    return zlib.crc32(text)


#: Fixed values of the 64-bit finaliser known as splitmix64.
MIX_1, MIX_2, MIX_STEP = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well mixed copy of unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64((seed + 1) * MIX_STEP & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x
