"""What the training-data operators share: stored intermediate tables, bounded samples, components, slices."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Callable, Iterator
from functools import wraps
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Edges of a graph in one part of its tables.
EDGES_A_PART = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``; where that is unset, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging").rstrip("/")


class Staging:
    """Intermediate tables of one run, in a folder of its own, so that single tables or all can be dropped again.

    What a lazy result still reads can't go before it is computed; the folder is deleted when the session ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{label}-{uuid4().hex}"
        self.paths: dict[str, str] = {}
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and read it back: nothing is computed twice or lost with an executor."""
        path = f"{self.folder}/{label}-{uuid4().hex[:8]}"
        df.write.parquet(path)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        """Delete tables that nothing reads any more, and let Spark delete the shuffle files of finished steps."""
        jvm = self.spark._jvm
        for label in labels:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(label))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        # Shuffle files go when the driver finds the plans that made them out of use; long runs should not wait for that.
        gc.collect()
        jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def sample_ids(df: DataFrame, id_column: str, size: int) -> DataFrame:
    """At most ``size`` ids, those with the smallest hashes: a fixed sample whatever the partitions."""
    ids = df.select(F.col(id_column).alias("_id")).where("_id is not null").distinct()
    return ids.orderBy(F.xxhash64("_id"), "_id").limit(size)


def sample_rows(df: DataFrame, id_column: str, size: int) -> DataFrame:
    """The rows of :func:`sample_ids`; the broadcast holds ``size`` ids at most."""
    return df.join(F.broadcast(sample_ids(df, id_column, size)), F.col(id_column) == F.col("_id"), "left_semi")


def in_slices(texts: list, most: int = 250_000) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of rows with about ``most`` characters each, so that arrays over tokens stay small."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def give_back() -> None:
    """Return memory that is free inside this Python process to the system. Workers outlive their tasks; what one has
    freed would count against its executor until the next task needs it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def lean(batches: Iterator[pa.RecordBatch], rows: int = 2_048) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what a task holds beside them stays small; free memory
    goes back after every batch given, and at the end of the task."""
    try:
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                yield batch.slice(low, rows)
            del batch
            give_back()
    finally:
        give_back()


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that also gives back what ``run`` itself held, such as words seen before: :func:`lean` ends while
    that is still in use."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def components(edges: DataFrame, staging: Staging, source: str = "src", target: str = "dst") -> DataFrame:
    """Connected components of an undirected graph: ``(node, component)``, the component being its smallest node.

    Large-star and small-star steps in turn (Kiveris et al., 2014) until the edges no longer change. Every step is
    an aggregation to one minimum per node and a join of two stored tables, which adaptive execution can split at
    a hub. Loops and null ends are ignored; nodes without an edge do not appear.
    """
    a, b = F.col(source), F.col(target)
    current = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current = staging.keep(current, "star-0")
    signature = None
    for step in range(1, 200):
        found = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (found.n, found.x) == signature or not found.n:
            break
        signature = found.n, found.x
        # Tables of few edges are written in few parts, whatever the number of shuffle partitions.
        parts = max(8, found.n // EDGES_A_PART)
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = staging.keep(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).coalesce(parts), f"lows-{step}")
        # A higher neighbour moves to the lowest node around; here v is the centre.
        large = staging.keep(
            current.select(F.col("v").alias("u"), F.col("u").alias("w")).join(lows, "u")
            .select(F.col("w").alias("u"), F.col("m").alias("v")).where("u <> v").distinct().coalesce(parts), f"large-{step}")
        mins = staging.keep(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), f"mins-{step}")
        joined = large.join(mins, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            mins.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        current = staging.keep(small.coalesce(parts), f"star-{step}")
        staging.drop(f"lows-{step}", f"large-{step}", f"mins-{step}", f"star-{step - 1}")
    else:
        raise RuntimeError("the components did not settle")
    roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def log2_rows(rows: int) -> int:
    return max(1, math.ceil(math.log2(max(2, rows))))
