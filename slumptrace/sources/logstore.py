"""A store of raw logs that can be added to again and again: one version per day, named by a manifest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slumptrace.operators.scale import delete_folder, materialize, small_side
from slumptrace.sources.readers import mark_lower

_KEY = ["transaction_hash", "log_index"]
_MANIFEST = "block_date date, version string, rows long"


def normalised(logs: DataFrame) -> DataFrame:
    """Logs as the scans want them: addresses and first topic in lower case, and the day. Rows without a time are dropped,
    as no scan of days can find them."""
    stored = logs.where("block_timestamp IS NOT NULL").withColumns({
        "address": F.lower("address"), "topic0": F.lower(F.get("topics", F.lit(0))), "block_date": F.to_date("block_timestamp")})
    return mark_lower(stored, "address")


def laid_out(stored: DataFrame) -> DataFrame:
    """Ranges of day, address and time, sorted by event and address: a busy day is several tasks, and scans skip well."""
    return stored.repartitionByRange("block_date", "address", "block_timestamp").sortWithinPartitions("block_date", "topic0", "address")


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def manifests(spark: SparkSession, store: str) -> list[str]:
    """The names of the finished manifests of a store, oldest first."""
    files, folder = _files(spark, f"{store}/manifests")
    if not files.exists(folder):
        return []
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    done = lambda name: files.exists(_files(spark, f"{store}/manifests/{name}/_SUCCESS")[1])
    return sorted(n for n in names if done(n))


def manifest(spark: SparkSession, store: str) -> dict[date, tuple[str, int]]:
    """Version and number of rows of every day; as many entries as the calendar has days."""
    names = manifests(spark, store)
    if not names:
        return {}
    rows = spark.read.schema(_MANIFEST).parquet(f"{store}/manifests/{names[-1]}").collect()
    return {r.block_date: (r.version, r.rows) for r in rows}


def load_logs(spark: SparkSession, store: str, days: Sequence[date] | None = None) -> DataFrame:
    """The logs of a store, or of some of its days. A folder without a manifest, and days it doesn't name, are refused."""
    held = manifest(spark, store)
    if not held:
        raise ValueError(f"{store} has no manifest: store logs with append_logs")
    if missing := sorted(set(days or ()) - held.keys()):
        raise ValueError(f"{store} has no logs of {', '.join(map(str, missing[:10]))}")
    paths = [f"{store}/data/version={v}/block_date={d}" for d, (v, _) in sorted(held.items()) if days is None or d in set(days)]
    found = spark.read.option("basePath", f"{store}/data").parquet(*paths)
    return found.drop("version").withColumn("block_date", F.col("block_date").cast("date"))


def append_logs(logs: DataFrame, store: str) -> int:
    """Add logs to a store and return how many rows were new.

    Each day in ``logs`` gets a new version, with what the store held of it and what is new by transaction and log index; of
    logs that share both, the one held stays. So adding the same logs again changes nothing, and logs may overlap or
    come late. The new manifest is written last: until then, and after a failure, readers see the old days. Versions that
    it no longer names are deleted after that. One writer at a time: a manifest that appeared meanwhile is refused.
    """
    spark = logs.sparkSession
    names, held = manifests(spark, store), manifest(spark, store)
    incoming = materialize(normalised(logs), "incoming")
    days = sorted(r.block_date for r in incoming.select("block_date").distinct().collect())
    known = [d for d in days if d in held]
    # Of one log the copy with the smallest content counts, whatever the order.
    content = F.xxhash64("address", "topic0", "data", "block_timestamp")
    first = Window.partitionBy("block_date", *_KEY).orderBy(content)
    fresh = incoming.withColumn("_first", F.row_number().over(first)).where("_first = 1").drop("_first")
    if known:
        old = load_logs(spark, store, known)
        fresh = fresh.join(old.select("block_date", *_KEY), ["block_date", *_KEY], "left_anti")
    fresh = materialize(fresh.select(*incoming.columns), "fresh")
    added = {r.block_date: r.n for r in fresh.groupBy("block_date").agg(F.count("*").alias("n")).collect()}
    if not added:
        return 0
    changed = spark.createDataFrame([(d,) for d in added], "block_date date")
    rows = fresh
    if again := [d for d in added if d in held]:
        rows = fresh.unionByName(load_logs(spark, store, again).select(*fresh.columns))
    version = uuid4().hex
    rows = rows.join(small_side(changed, len(added)), "block_date", "left_semi")
    laid_out(mark_lower(rows, "address")).write.partitionBy("block_date").parquet(f"{store}/data/version={version}")
    now = {**held, **{d: (version, n + held.get(d, ("", 0))[1]) for d, n in added.items()}}
    if manifests(spark, store) != names:
        delete_folder(spark, f"{store}/data/version={version}")
        raise RuntimeError(f"{store} was written to meanwhile")
    spark.createDataFrame([(d, v, n) for d, (v, n) in sorted(now.items())], _MANIFEST).coalesce(1).write.parquet(
        f"{store}/manifests/{len(names):08}-{version}")
    for day in again:
        delete_folder(spark, f"{store}/data/version={held[day][0]}/block_date={day}")
    return sum(added.values())
