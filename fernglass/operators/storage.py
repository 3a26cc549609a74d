"""Tables in the folder that all executors share, where lineage ends and intermediate results survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset a local session gets one of this machine, and a cluster an error."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = os.path.join(tempfile.gettempdir(), "checkpoints", "fernglass")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def place(spark: SparkSession, name: str) -> str:
    """A path of its own, for a table or files of this application."""
    return f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stashed_at = path
    return found


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def mounted(path: str) -> str:
    """The path as the operating system knows it, for what must open files itself."""
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"{path} is not a mounted folder")
    return path.removeprefix("file://").removeprefix("file:")
