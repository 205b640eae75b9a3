"""Incremental ingestion: new clip files only, the checkpoint in place of marker files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelmill.functions.expressions import parent_label, stem


def ingest_new(spark: SparkSession, folder: str, out: str, checkpoint: str, suffix: str = ".mp4") -> StreamingQuery:
    """Appends files not seen before to a Parquet table by label, once for each content; ends when all are in."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(folder)
    rows = files.withColumn("label", parent_label("path")).withColumn("stem", stem("path")).withColumn("md5", F.md5("content")).dropDuplicates(["md5"])
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).partitionBy("label").trigger(availableNow=True).start()
