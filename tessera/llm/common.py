"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import gc
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

# Worker functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules["tessera.llm"])

#: Rows and bytes of one Arrow batch handed to a Python worker (a batch ends at whichever is
#: reached first, so it holds one row more than so many bytes); bounds a worker's memory.
BATCH_ROWS = 500
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches for this session unless it already bounds them tighter."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        held = str(spark.conf.get(key, None) or 0)
        if not held.isdecimal() or not 0 < int(held) <= most:
            spark.conf.set(key, str(most))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's spark.checkpoint.dir, or one
    of our own where none is set and driver and executors are one machine (tests)."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not found and sc.getCheckpointDir():
        found = sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts lineage, and a lost
    executor takes nothing with it."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the driver forgets their job, not when it happens to collect."""
    gc.collect()
    spark._jvm.System.gc()


#: Rows of a stored table of ids that may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame):
    """A stored table of ids, to be broadcast if it is small enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def fold(column: str = "doc_id", modulus: int = 5):
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def released(run):
    """A worker function that, once a task is done, gives freed memory back to the system:
    Spark keeps idle workers, and what their tables held would count on top of the next
    stage's."""

    def wrapped(batches):
        yield from run(batches)
        import ctypes

        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return wrapped


def binary_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 of a text column; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    column = batch.column(batch.schema.get_field_index(name))
    return ["" if x is None else x for x in column.to_pylist()]


def keep(batch: pa.RecordBatch, *names: str) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def bit_table(df: DataFrame, column: str, bits: int):
    """A table of 2 ** bits bits, set at the values of ``column`` (0 to 2 ** bits - 1), as
    bytes.  Spark's bitmap aggregates build it in blocks of 32768 bits, so the driver
    receives 2 ** bits bits at most."""
    at = F.col(column).cast("long") + 1
    blocks = df.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("set"))
    size = 1 << 12
    raw = bytearray((1 << max(bits, 15)) // 8)
    for r in blocks.collect():
        raw[(r.b - 1) * size : r.b * size] = r.set
    return bytes(raw)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of edges (a, b: long) by alternating large-star and small-star
    steps: rows (node, root), root the smallest node; only nodes that have an edge.
    Every step is written to the shared folder, and the one before it deleted; nothing is
    gathered on the driver but whether it was the last."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = store(edges.filter("a <> b").select(high.alias("a"), low.alias("b")).distinct(), name)
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b")
        before, edges = edges, store(small.distinct(), name)
        remove(before)
        # Done once every node hangs on one root and no root hangs on another.
        sides = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)).distinct())
        if sides.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).filter("up > 1 or up > 0 and down > 0").isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", F.col("b").alias("r")).distinct())
