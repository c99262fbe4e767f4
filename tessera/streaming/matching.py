"""Anchors as a stream against static candidates.

Each micro-batch holds whole anchor rows and runs the batch pipeline; the checkpoint folder
takes the place of resume markers, and a batch is written under its own number, so a
repeated batch replaces itself.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])


def work_dir(spark: SparkSession) -> str:
    """A new folder for a stream's output: below spark.checkpoint.dir, or where that is unset
    and everything is one machine, a temporary one."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not found and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{found.rstrip('/')}/tessera-stream-{uuid.uuid4().hex}" if found else "file://" + tempfile.mkdtemp(prefix="tessera-stream-")


def anchor_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def match_stream(anchors: DataFrame, candidates: DataFrame, match: Callable[[DataFrame, DataFrame], DataFrame], out: str, checkpoint: str):
    """Start the query; ``match`` is the batch pipeline (anchors, candidates) -> pairs."""

    def batch(rows: DataFrame, number: int) -> None:
        match(rows, candidates).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return anchors.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
