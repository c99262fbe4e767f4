"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.streaming.matching import work_dir


def store(df: DataFrame) -> DataFrame:
    """Write a table and read it back.  Its shuffle files go at once, not when the driver
    happens to collect what it has forgotten."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/part-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = df.schema
    del df
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    spark: SparkSession = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
