"""Scratch tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, one machine makes its own; a cluster has to be told."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="eventweir-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/eventweir/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written and read back, which cuts its lineage and survives lost executors."""
    at = path(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
