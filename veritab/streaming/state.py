"""Where streams keep their progress, and jobs what several of their results rest on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir, or that which setCheckpointDir was given; a local one only where neither is
    set and Spark is local."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="veritab-stream-")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: what several results rest on is worked out once."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
