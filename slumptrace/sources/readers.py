"""Scans of the input tables: needed columns only, normalised once, predicates next to the scan.

Addresses are lower-cased here. Those of stored tables and logs are in lower case already and marked so; they are taken as
they are, so that a scan can skip by them. Everything behind a reader compares addresses with plain equality.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slumptrace.constants import (
    PAIR_CREATED_TOPIC, PAIR_FACTORY, SWAP_TOPIC,
)
from slumptrace.functions.logs import has_topic
from slumptrace.functions.values import number
from slumptrace.operators.scale import small_side
from slumptrace.schemas import Table
from slumptrace.sources.catalog import is_normalised

# Notes on columns of stored tables.
_LOWER, _BUCKETS = "lower_case", "buckets"


def load(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path. A folder of ``logstore`` is read by its manifest."""
    if "/" in source:
        from slumptrace.sources import logstore

        if logstore.manifests(spark, source.rstrip("/")):
            return logstore.load_logs(spark, source.rstrip("/"))
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def load_table(spark: SparkSession, database: str, table: Table) -> DataFrame:
    """A table of the data model. What the sink has stored of it is marked, so that readers can rely on it."""
    df = spark.table(f"{database}.{table.name}")
    return mark_stored(df, table) if is_normalised(spark, database, table.name) else df


def mark_stored(df: DataFrame, table: Table) -> DataFrame:
    """Note on each address column that it is in lower case, and how many buckets the rows lie in by it."""
    for name in table.addresses:
        held = table.buckets if table.cluster_by[:1] == (name,) else 0
        df = df.withMetadata(name, {_LOWER: True, _BUCKETS: held})
    return df


def mark_lower(df: DataFrame, name: str) -> DataFrame:
    """Note on a column that it is in lower case. The note is written to Parquet files and read back with them."""
    return df.withMetadata(name, {_LOWER: True})


def lower_address(df: DataFrame, name: str = "token_address") -> Column:
    """The address in lower case; one that is marked so is taken as it is, which keeps its buckets."""
    return F.col(name) if _is_lower(df, name) else F.lower(name).alias(name)


def _is_lower(df: DataFrame, name: str) -> bool:
    return df.schema[name].metadata.get(_LOWER, False)


def stored_buckets(df: DataFrame, name: str = "token_address") -> int:
    """How many buckets the rows lie in by this column; 0 if that is not known."""
    return df.schema[name].metadata.get(_BUCKETS, 0) if name in df.columns else 0


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when an input that must not be empty is; for job runners, as it starts a small job."""
    if df.isEmpty():
        raise ValueError(f"no {what} found")
    return df


def crisis_events(events: DataFrame) -> DataFrame:
    """The columns of a crisis that the analysis needs."""
    return events.select(
        "crisis_id",
        F.lower("token_address").alias("token_address"),
        "window_start_date",
        "window_end_date",
        "crisis_name",
    )


def pools(dimension: DataFrame) -> DataFrame:
    """Pool, token pair and protocol, and the decimals of the tokens where the dimension has them."""
    return dimension.select(
        *[F.lower(c).alias(c) for c in ("pool_address", "token0_address", "token1_address")], "dex_protocol",
        *[c for c in ("token0_decimals", "token1_decimals") if c in dimension.columns],
    )


def pool_names(dimension: DataFrame) -> DataFrame:
    """Pools in the order of the verification report."""
    return dimension.select("pool_address", "pool_name", "dex_protocol").orderBy("dex_protocol", "pool_name")


def staged_buys(buys: DataFrame) -> DataFrame:
    """The output of stage one, as stage two reads it. NaN, which would count as the highest price, becomes null."""
    return buys.select(
        "crisis_id", "wallet_address", F.lower("token_address").alias("token_address"), "first_buy_timestamp",
        *[number(F.col(c)).alias(c) for c in ("first_buy_price", "total_amount_bought", "total_usd_spent")],
        "num_transactions",
    )


def moment(text: str | datetime) -> datetime:
    """A bound as given by a user, such as ``2021-9-15`` or ``2021-09-15 12:00``. What is no date or time is refused."""
    if isinstance(text, datetime):
        return text
    found = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})(?:[ T](\d{1,2}):(\d{2})(?::(\d{2}))?)?", text.strip())
    if not found:
        raise ValueError(f"{text!r} is no date or time")
    return datetime(*[int(part or 0) for part in found.groups()])


def between_times(df: DataFrame, column: str, start: str | datetime | None, end: str | datetime | None) -> DataFrame:
    """Rows with ``start <= column <= end``. A bare date as upper bound means its midnight.

    The bounds take the type of the column, with or without time zone, so they can reach the scan.
    """
    start, end = [None if bound is None else str(moment(bound)) for bound in (start, end)]
    kind = df.schema[column].dataType
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast(kind))
    return df


def _topic_in(logs: DataFrame, topics: Sequence[str]) -> Column:
    # A stored copy of the first topic lets Parquet skip row groups, which an array element cannot.
    if "topic0" in logs.columns:
        return F.col("topic0").isin(list(topics))
    if _is_lower(logs, "address"):
        return reduce(or_, [has_topic(F.col("topics"), topic) for topic in topics])
    return F.lower(F.get("topics", F.lit(0))).isin([t.lower() for t in topics])


def swap_logs(
    logs: DataFrame,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    pool_keys: DataFrame | None = None,
    topics: Sequence[str] = (SWAP_TOPIC,),
    days: Sequence[date] | None = None,
) -> DataFrame:
    """Swap events of a time range, of the pools in ``pool_keys`` if given; all of them without bounds.

    Logs laid out by ``jobs.store_logs`` or ``logstore.append_logs`` are in lower case and partitioned by ``block_date``;
    then only the ``days`` asked for are read. Raw logs are lower-cased as they are read.
    """
    if days is not None and "block_date" in logs.columns:
        logs = logs.where(F.col("block_date").isin(list(days)))
    scan = between_times(logs.where(_topic_in(logs, topics)), "block_timestamp", start, end).select(
        "block_timestamp",
        "transaction_hash",
        "log_index",
        lower_address(logs, "address").alias("pool_address"),
        (F.col("topic0") if "topic0" in logs.columns else F.get("topics", F.lit(0))).alias("swap_topic"),
        *[c for c in ("topics",) if c in logs.columns],
        "data",
    )
    if pool_keys is None:
        return scan
    keys = small_side(pool_keys.select("pool_address").distinct())
    return scan.join(keys, "pool_address", "left_semi")


def senders(
    transactions: DataFrame,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    days: Sequence[date] | None = None,
) -> DataFrame:
    """Sender per transaction. The range applies where transactions carry their block time.

    Of transactions partitioned by ``block_date`` only the ``days`` are read, and the date comes along as a join key.
    """
    if days is not None and "block_date" in transactions.columns:
        transactions = transactions.where(F.col("block_date").isin(list(days)))
    if "block_timestamp" in transactions.columns:
        transactions = between_times(transactions, "block_timestamp", start, end)
    return transactions.select(
        F.col("hash").alias("transaction_hash"), F.lower("from_address").alias("wallet_address"),
        *[F.col("block_date").cast("date").alias("block_date") for c in ("block_date",) if c in transactions.columns],
    )


def factory_logs(
    logs: DataFrame,
    factories: Iterable[str] = (PAIR_FACTORY,),
    topics: Sequence[str] = (PAIR_CREATED_TOPIC,),
    since: str | datetime | None = None,
) -> DataFrame:
    """Pair-created events of the known factories, from ``since`` on if given."""
    address = lower_address(logs, "address")
    wanted = logs.where(address.isin(list(factories)) & _topic_in(logs, topics))
    return between_times(wanted, "block_timestamp", since, None).select(
        "block_timestamp", address.alias("address"), "topics", "data"
    )


def prices(
    history: DataFrame,
    tokens: DataFrame | None = None,
    first: object | None = None,
    last: object | None = None,
    token_rows: int | None = None,
) -> DataFrame:
    """One price per token and day, optionally for some tokens and days only.

    ``token_rows`` is the number of rows in ``tokens``, if it has been measured. NaN becomes null. Of several rows for one token and day the highest price counts.
    """
    quotes = history.select(
        lower_address(history),
        F.col("dt").cast("date").alias("dt"),
        number(F.col("price_usd")).alias("price_usd"),
    )
    if first is not None:
        quotes = quotes.where(F.col("dt") >= F.lit(first).cast("date"))
    if last is not None:
        quotes = quotes.where(F.col("dt") <= F.lit(last).cast("date"))
    if tokens is not None:
        keys = tokens.select("token_address")
        # Duplicates do no harm in a semi join; they are only worth a shuffle if their number is unknown.
        keys = small_side(keys.distinct()) if token_rows is None else small_side(keys, token_rows)
        quotes = quotes.join(keys, "token_address", "left_semi")
    return quotes.groupBy("token_address", "dt").agg(F.max("price_usd").alias("price_usd"))
