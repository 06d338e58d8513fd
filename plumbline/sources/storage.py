"""The shared folder, and results that are written there once and read as often as needed."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: the one that spark.checkpoint.dir names.

    Only a local master, whose executors are this machine, may leave the setting out; a folder of our own
    is set there. What lies in the folder is deleted when the driver's JVM ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = os.path.join(tempfile.gettempdir(), "plumbline-checkpoints")
        context.setCheckpointDir(folder)
    folder = context.getCheckpointDir()
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """df written to the shared folder, so it is computed once, survives lost executors and reads the same everywhere."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table of the shared folder: smaller than a checkpoint where rows have long values."""
    folder = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def forget(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that is no longer read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
