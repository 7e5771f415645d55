"""Data-quality reports: one row per rule, pool, crisis or table, each from a single pass."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, TimestampNTZType, TimestampType

from slumptrace.constants import MAX_CRISIS_MOVE_PCT, MOVE_OFFSET_DAYS
from slumptrace.operators import scale
from slumptrace.operators.pricing import price_at_offsets
from slumptrace.operators.scale import small_side
from slumptrace.schemas import STAGED_BUYS
from slumptrace.sources.readers import between_times, lower_address

_AMOUNTS = ["first_buy_price", "total_amount_bought", "total_usd_spent"]


def validate_buys(df: DataFrame) -> DataFrame:
    """Violations per rule of the staged-buy table: ``rule``, ``column``, ``violations``.

    Presence and type of columns are read from the schema; the value rules share one aggregation.
    """
    checks: list[tuple[str, str, Column]] = []
    present = set(df.columns)
    for field in STAGED_BUYS.schema:
        name = field.name
        checks.append(("present", name, F.lit(int(name not in present))))
        if name not in present:
            continue
        kind = df.schema[name].dataType
        if not field.nullable:
            checks.append(("not_null", name, F.count_if(F.col(name).isNull())))
        if isinstance(field.dataType, TimestampType):
            checks.append(("type", name, F.lit(int(not isinstance(kind, (TimestampType, TimestampNTZType))))))
        elif isinstance(field.dataType, NumericType):
            checks.append(("type", name, F.lit(int(not isinstance(kind, NumericType)))))
            if name in _AMOUNTS and isinstance(kind, NumericType):
                checks.append(("not_negative", name, F.count_if(F.col(name) < 0)))
    if "num_transactions" in present:
        checks.append(("exactly_one", "num_transactions", F.count_if(~F.col("num_transactions").eqNullSafe(F.lit(1)))))
    row = df.agg(*[value.cast("bigint").alias(f"check_{i}") for i, (_, _, value) in enumerate(checks)])
    report = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("column"), F.col(f"check_{i}").alias("violations"))
        for i, (rule, name, _) in enumerate(checks)
    ])
    return row.select(F.inline(report))


def require_valid(df: DataFrame) -> None:
    """Fail with every violated rule of the staged-buy table."""
    broken = validate_buys(df).where("violations > 0").collect()
    if broken:
        raise ValueError("; ".join(f"{r['rule']}({r['column']}): {r['violations']}" for r in broken))


def check_crisis_moves(
    events: DataFrame,
    history: DataFrame,
    max_move_pct: float = MAX_CRISIS_MOVE_PCT,
    offset_days: int = MOVE_OFFSET_DAYS,
) -> DataFrame:
    """Every crisis with all three prices, and whether its price fell at least as far as expected."""
    moves = price_at_offsets(events, history, offset_days)
    return moves.na.drop(
        subset=["price_before_crisis", "price_during_crisis", "price_after_recovery"]
    ).withColumn("realistic", F.col("crisis_drop_pct") <= max_move_pct)


def crisis_moves_summary(checked: DataFrame) -> DataFrame:
    """One row: crises compared, unrealistic ones, and the verdict. No comparable crisis fails."""
    wrong = F.count_if(~F.coalesce("realistic", F.lit(True)))
    return checked.agg(
        F.count("*").alias("crises"),
        wrong.alias("unrealistic"),
        ((F.count("*") > 0) & (wrong == 0)).alias("passed"),
    )


def sample_rows(df: DataFrame, n: int, seed: int = 0, key: str | None = None) -> DataFrame:
    """``n`` rows as a spot check to look at; the checks themselves use all rows.

    Those whose ``key`` (the first column, unless given) has the smallest hash with ``seed``, so a seed always names the same
    rows, whatever the partitions; another seed names others. Equal keys go by all columns, null keys come last.
    """
    key = key or df.columns[0]
    mixed = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    ties = [F.col(f.name) for f in df.schema if f.dataType.simpleString().partition("<")[0] not in ("map", "variant")]
    return df.orderBy(F.asc_nulls_last(mixed), *ties).limit(n)


# Up to this many pools are looked for by name, which the scan can skip row groups by.
NAMED_POOLS = 2_000


def pool_activity(logs: DataFrame, pools: DataFrame, since: str | None = None) -> DataFrame:
    """Log count, first and last time per pool seen in the logs, from ``since`` on if given.

    Only logs of known pools are counted: a few pools are a filter next to the scan, more are a broadcast the scan is
    joined to. Beyond that logs are counted per address first, which leaves one row per address and task to be shuffled.
    """
    seen = between_times(logs, "block_timestamp", since, None).select(
        lower_address(logs, "address").alias("pool_address"), "block_timestamp"
    )
    keys = pools.select(F.lower("pool_address").alias("pool_address")).where("pool_address IS NOT NULL").distinct()
    named = keys.limit(NAMED_POOLS + 1).collect()
    if len(named) <= NAMED_POOLS:
        return _activity(seen.where(F.col("pool_address").isin([r["pool_address"] for r in named])))
    rows = keys.count()
    if rows <= scale.BROADCAST_ROWS:
        return _activity(seen.join(small_side(keys, rows), "pool_address", "left_semi"))
    return _activity(seen).join(keys, "pool_address", "left_semi")


def _activity(seen: DataFrame) -> DataFrame:
    return seen.groupBy("pool_address").agg(
        F.count("*").alias("transaction_count"),
        F.min("block_timestamp").alias("first_seen"),
        F.max("block_timestamp").alias("last_seen"),
    )


def pools_with_activity(pools: DataFrame, activity: DataFrame) -> DataFrame:
    """All pools with their activity; pools never seen count 0."""
    return pools.join(activity, "pool_address", "left").fillna(0, ["transaction_count"])


def pool_coverage(pools: DataFrame, activity: DataFrame) -> DataFrame:
    """One row: pools seen in the logs, pools not seen, their shares, and whether any was seen."""
    used = F.count_if(F.col("transaction_count") > 0)
    unused = F.count_if(F.col("transaction_count") == 0)
    return pools_with_activity(pools, activity).agg(
        F.count("*").alias("pools"),
        used.alias("real_pools"),
        unused.alias("mock_pools"),
        F.round(F.try_divide(used, F.count("*")) * 100.0, 1).alias("real_pct"),
        F.round(F.try_divide(unused, F.count("*")) * 100.0, 1).alias("mock_pct"),
        (used > 0).alias("passed"),
    )


def check_completeness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, and whether it has any."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("passed", F.col("row_count") > 0)


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """One row: how many rows, and how many distinct values each column has."""
    return df.agg(
        F.count("*").alias("row_count"), *[F.count_distinct(c).alias(f"distinct_{c}") for c in columns]
    )


# Sketches of 2 ** 14 registers; their estimates are within 3 % of the truth but for one in ten thousand.
SKETCH_BITS, SKETCH_BOUND = 14, 0.03


def daily_sketches(df: DataFrame, day: str, *columns: str) -> DataFrame:
    """Per day the number of rows and a sketch of the distinct values of each column, to be kept beside the data.

    A sketch has a fixed size, and sketches of several days add up to that of all their rows, so a span of days is
    counted without reading its rows again.
    """
    return df.groupBy(F.to_date(day).alias("day")).agg(
        F.count("*").alias("row_count"), *[F.hll_sketch_agg(c, F.lit(SKETCH_BITS)).alias(c) for c in columns])


def distinct_estimates(sketches: DataFrame, *columns: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """One row: how many rows the days from ``first`` to ``last`` have, and about how many distinct values each column."""
    if first is not None:
        sketches = sketches.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        sketches = sketches.where(F.col("day") <= F.lit(last).cast("date"))
    return sketches.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(f"distinct_{c}") for c in columns])
