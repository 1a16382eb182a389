"""Tables between steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only where it is unset, as in tests, a folder is made."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    made = getattr(spark, "_tideline_dir", None)
    if made is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        made = spark._tideline_dir = tempfile.mkdtemp(prefix="tideline-")
    return f"file://{made}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/tideline/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.getParent())
    fs.deleteOnExit(hadoop)
    return path


def materialise(df: DataFrame, name: str, *parts: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, so a lost executor costs no recomputation of what came before. parts: columns by whose values files are kept apart."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*parts).parquet(path) if parts else df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
