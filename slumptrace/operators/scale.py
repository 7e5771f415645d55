"""Three things Spark leaves to the caller at scale: checked broadcasts, staging, and numbering big groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Dimension rows are a few hundred bytes, so this bounds a broadcast at well under 100 MB per executor.
BROADCAST_ROWS = 200_000
# The largest group that is still sorted inside one task.
TASK_ROWS = 2_000_000

# The folder of the run that is going on, if any.
_RUN: ContextVar[str | None] = ContextVar("staged_run", default=None)


def small_side(df: DataFrame, rows: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Mark a dimension for broadcast if it is known, or has been counted, to be small.

    ``rows`` is an upper bound the caller has measured already. A larger side is returned as it is: the
    join then shuffles both sides, and adaptive execution splits the partitions of hot keys. Only for
    dimensions that are cheap against what they are joined to.
    """
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    return F.broadcast(df) if (df.count() if rows is None else rows) <= limit else df


def staging_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as named by ``spark.checkpoint.dir``."""
    if (run := _RUN.get()) is not None:
        return run
    folder = spark.conf.get("spark.checkpoint.dir", None)
    # Where it is unset: the warehouse is shared by all executors as well.
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging").rstrip("/")


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of any file system that Spark can write to; one that is not there is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[str]:
    """A run whose intermediate tables lie in a folder of its own, which is deleted when the run is over.

    Everything the run returns must be stored or computed by then.
    """
    folder = f"{staging_folder(spark)}/run-{uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        delete_folder(spark, folder)


def materialize(df: DataFrame, label: str, compact: bool = False) -> DataFrame:
    """Write ``df`` once to the staging folder and read it back.

    Used where a result is needed more than once: it is neither computed again nor lost with an executor.
    With ``compact`` the few rows left over by each task of a large scan are gathered into files of a good size.
    Outside of :func:`staged_run` the table stays until the session ends, as a lazy result may read it.
    """
    path = f"{staging_folder(df.sparkSession)}/{label}-{uuid4().hex}"
    (df.hint("rebalance") if compact else df).write.parquet(path)
    if _RUN.get() is None:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(place)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int, label: str = "slices", most: int | None = None
) -> DataFrame:
    """``df`` stored in ranges of ``keys`` and ``order``, about equal in size, with the range of each row in ``_slice``.

    A large group falls into several neighbouring slices; rows that are equal in all columns of the order stay together.
    With ``most`` the rows of a group in one range are cut further, ``most`` to a slice. A range is a task, so there should
    not be more of them than tasks are good for, however fine the slices are.
    """
    ranged = df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id())
    if most is not None:
        place = F.rank().over(Window.partitionBy(*keys, "_slice").orderBy(*order)) - 1
        ranged = ranged.withColumn("_slice", F.shiftleft(F.col("_slice").cast("long"), 32) + F.floor(place / most))
    return materialize(ranged, label)


def number_rows(
    df: DataFrame,
    order: Sequence[Column],
    within: Sequence[str] = (),
    name: str = "row_number",
    largest: int | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Number the rows 1, 2, … of each group in the given order.

    ``largest`` is the size of the largest group if the caller knows it. Groups beyond ``task_rows`` are
    cut into sorted slices: rows are numbered inside their slice, and shifted by what lies before it.
    """
    task_rows = TASK_ROWS if task_rows is None else task_rows
    within = list(within)
    if largest is None:
        largest = df.groupBy(*within).count().agg(F.max("count")).first()[0] or 0
    if largest <= task_rows:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))

    ranged = df.repartitionByRange(*[F.col(c) for c in within], *order)
    sliced = materialize(ranged.withColumn("_slice", F.spark_partition_id()), "slices")
    sizes = sliced.groupBy("_slice", *within).agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col("_slice").alias("_of"),
        *[F.col(c).alias(f"_of_{c}") for c in within],
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"),
    )
    inside = Window.partitionBy("_slice", *within).orderBy(*order)
    same_slice = F.col("_slice") == F.col("_of")
    for c in within:
        same_slice = same_slice & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return (
        sliced.withColumn("_inside", F.row_number().over(inside))
        .join(shifts, same_slice)
        .withColumn(name, (F.col("_inside") + F.col("_shift")).cast("bigint" if largest > 2**31 - 1 else "int"))
        .select(*df.columns, name)
    )
