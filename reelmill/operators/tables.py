"""Written intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; only where that is unset and Spark is one process, a local one."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="reelmill-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/catalogue-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
