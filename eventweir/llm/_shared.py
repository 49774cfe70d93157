"""Scratch tables in the folder that the whole cluster shares, and small column helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SCRATCH: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset one machine makes and sets its own, and a cluster has to be told."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="eventweir-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that was never used before."""
    path = f"{shared_dir(spark)}/eventweir/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: it cuts the lineage and survives lost executors."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Deletes every scratch table of this process; call it when no returned DataFrame is needed any more."""
    jvm, conf, n = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{os.fspath(sf_dir).rstrip('/')}/{name}.parquet")


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))
