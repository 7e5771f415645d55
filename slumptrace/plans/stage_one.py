"""Stage one: from raw logs to staged, priced buys of crashed tokens."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slumptrace.constants import DEFAULT_PRICE, RECOVERY_DAYS, TOKEN_DECIMALS
from slumptrace.functions.logs import PROTOCOLS, Protocol
from slumptrace.functions.values import number, valid_key
from slumptrace.operators import pools as pool_ops
from slumptrace.operators import pricing, swaps
from slumptrace.operators.labels import buys_after_crash, hours_after, realised_profit
from slumptrace.operators.scale import materialize, small_side
from slumptrace.schemas import STAGED_BUYS
from slumptrace.sources import readers


@dataclass(frozen=True)
class StageOneOptions:
    """Settings of stage one.

    Without ``start`` and ``end`` the log scan is bounded by the crisis windows, outside of which no swap
    counts. ``latest`` keeps only that many of the newest swaps; it is off because it loses older buys.
    """

    start: str | None = None
    end: str | None = None
    latest: int | None = None
    decode: str = "abi"
    decimals: int | Column = TOKEN_DECIMALS
    protocols: Sequence[Protocol] = PROTOCOLS
    clip_history: bool = True
    default_price: float = DEFAULT_PRICE
    # Only buys that many hours after the start of their crisis day, instead of the crises' own windows.
    hours: tuple[int, int] | None = None


@dataclass(frozen=True)
class CrisisSpan:
    """How many crises there are, and the first and last day of their windows."""

    count: int
    first: date | None
    last: date | None


def crisis_span(events: DataFrame) -> CrisisSpan:
    """Measured once, it bounds the log scan and proves the crises small enough to broadcast."""
    row = events.agg(F.count("*"), F.min("window_start_date"), F.max("window_end_date")).first()
    return CrisisSpan(*row)


def scan_bounds(span: CrisisSpan, options: StageOneOptions) -> tuple[str | datetime | None, str | datetime | None]:
    """Time range of the log scan: the given one, narrowed to the crisis windows."""
    if span.first is None or span.last is None:
        return options.start, options.end
    starts = [readers.moment(str(span.first)), *([readers.moment(options.start)] if options.start else [])]
    ends = [readers.moment(str(span.last + timedelta(days=1))), *([readers.moment(options.end)] if options.end else [])]
    return max(starts), min(ends)


def window_days(events: DataFrame) -> list[date]:
    """The distinct days of all windows, for pruning partitions by day: as many as the calendar has, at most."""
    days = events.where("window_start_date <= window_end_date").select(
        F.explode(F.sequence("window_start_date", "window_end_date")).alias("day"))
    return sorted(r.day for r in days.distinct().collect())


def window_swaps(
    events: DataFrame,
    pools: DataFrame,
    logs: DataFrame,
    options: StageOneOptions = StageOneOptions(),
    span: CrisisSpan | None = None,
) -> DataFrame:
    """Swaps of crisis pools inside the windows of their crises."""
    span = crisis_span(events) if span is None else span
    crossed = pool_ops.crisis_pools(readers.pools(pools), readers.crisis_events(events), span.count)
    pieces = materialize(swaps.window_pieces(crossed), "pieces")
    topics = sorted({p.swap_topic for p in options.protocols})
    if options.latest is None:
        days = window_days(events) if "block_date" in logs.columns else None
        found = readers.swap_logs(logs, *scan_bounds(span, options), topics=topics, days=days)
    else:
        # The newest swaps are taken from the configured range, before windows are looked at.
        found = swaps.latest(readers.swap_logs(logs, options.start, options.end, pieces, topics), options.latest)
    return swaps.in_pieces(found, pieces)


def unpriced_buys(
    events: DataFrame,
    pools: DataFrame,
    logs: DataFrame,
    transactions: DataFrame,
    options: StageOneOptions = StageOneOptions(),
) -> DataFrame:
    """Buys with wallet and amount, in the columns of the staged table.

    Transactions are as many as logs, while few swaps are buys. The buys found are therefore stored and
    counted; as long as they are few they go to the transactions, which are then not shuffled at all. Of transactions
    partitioned by ``block_date`` only the days of the buys are read and joined by day and hash.
    """
    if options.hours is not None:
        events = hour_windows(events, options.hours)
    span = crisis_span(events)
    decimals = swaps.pool_decimals(pools, options.decimals)
    bought = swaps.crisis_buys(
        window_swaps(events, pools, logs, options, span), options.decode, decimals, options.protocols
    )
    bought = materialize(
        bought.select("crisis_id", "crisis_token", "block_timestamp", "transaction_hash", "token_amount"),
        "bought", compact=True,
    )
    days = None
    if "block_date" in transactions.columns:
        days = sorted(r.day for r in bought.select(F.to_date("block_timestamp").alias("day")).distinct().collect())
    senders = readers.senders(transactions, *scan_bounds(span, options), days=days)
    buys = swaps.by_valid_wallets(swaps.with_sender(small_side(bought), senders)).select(
        "crisis_id",
        "wallet_address",
        F.col("crisis_token").alias("token_address"),
        F.col("block_timestamp").cast("timestamp").alias("first_buy_timestamp"),
        F.col("token_amount").alias("total_amount_bought"),
    )
    return buys if options.hours is None else buys_after_crash(buys, events, *options.hours)


def hour_windows(events: DataFrame, hours: tuple[int, int]) -> DataFrame:
    """Crises with day windows that hold all of the given hours after the start of the crisis day."""
    first, last = hours
    return events.withColumns({
        "window_start_date": F.date_add("crisis_date", first // 24), "window_end_date": F.date_add("crisis_date", last // 24)})


def window_trades(
    events: DataFrame,
    pools: DataFrame,
    logs: DataFrame,
    transactions: DataFrame,
    options: StageOneOptions = StageOneOptions(),
    recovery_days: int = RECOVERY_DAYS,
) -> DataFrame:
    """Buys inside the windows and sales up to ``recovery_days`` after them, per wallet and token; stored.

    A swap that several crises of a token see is one trade; it is a buy if any of their windows holds it. With
    ``options.hours`` only buys of those hours after the start of the crisis day count.
    """
    if options.hours is not None:
        events = hour_windows(events, options.hours)
    wider = events.withColumn("window_end_date", F.date_add("window_end_date", recovery_days))
    span = crisis_span(wider)
    day = F.to_date("block_timestamp")
    inside = day <= F.col("last_buy_date")
    if options.hours is not None:
        inside = inside & hours_after(F.col("block_timestamp").cast("timestamp"), F.col("crisis_date"), options.hours)
    bounds = small_side(
        events.select("crisis_id", "crisis_date", F.col("window_end_date").alias("last_buy_date")), span.count)
    decimals, topic = swaps.pool_decimals(pools, options.decimals), F.col("swap_topic")
    key = ["transaction_hash", "log_index", "pool_address", "crisis_token", "block_timestamp"]
    found = window_swaps(wider, pools, logs, options, span).select(
        *key, "crisis_id",
        swaps.bought_amount(options.decode, decimals, options.protocols, topic).alias("bought"),
        swaps.sold_amount(decimals, options.protocols, topic).alias("sold"),
    ).where("bought > 0 OR sold > 0").join(bounds, "crisis_id").groupBy(*key).agg(
        F.max(F.when(inside, F.col("bought"))).alias("bought"), F.max("sold").alias("sold"))
    found = materialize(found.where("bought > 0 OR sold > 0"), "trades", compact=True)
    days = None
    if "block_date" in transactions.columns:
        days = sorted(r.day for r in found.select(F.to_date("block_timestamp").alias("day")).distinct().collect())
    traded = swaps.by_valid_wallets(swaps.with_sender(small_side(found), readers.senders(transactions, days=days))).select(
        "wallet_address", F.col("crisis_token").alias("token_address"),
        F.col("block_timestamp").cast("timestamp").alias("traded_at"), "bought", "sold")
    return materialize(traded, "traded")


def price_trades(traded: DataFrame, history: DataFrame, default_price: float = DEFAULT_PRICE) -> DataFrame:
    """Trades with the price of their token on their day."""
    priced = pricing.price_buys(
        traded, history, clip_history=False, default_price=default_price, timestamp="traded_at", amount="bought")
    return priced.withColumnRenamed("first_buy_price", "price").drop("total_usd_spent")


def realised_trades(
    events: DataFrame,
    pools: DataFrame,
    logs: DataFrame,
    transactions: DataFrame,
    history: DataFrame,
    options: StageOneOptions = StageOneOptions(),
    recovery_days: int = RECOVERY_DAYS,
    walk_rows: int | None = None,
) -> DataFrame:
    """From raw logs to the realised profit per wallet and token."""
    traded = window_trades(events, pools, logs, transactions, options, recovery_days)
    sizes = traded.groupBy("wallet_address", "token_address").count()
    rows, largest = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    return realised_profit(price_trades(traded, history, options.default_price), recovery_days, rows, largest, walk_rows)


def format_buys(priced: DataFrame) -> DataFrame:
    """The columns and types of the staged table; rows without a usable key are dropped."""
    keys = [f.name for f in STAGED_BUYS.schema if f.dataType.simpleString() == "string"]
    kept = priced.withColumn("num_transactions", F.lit(1).cast("bigint")).where(
        F.col("first_buy_timestamp").isNotNull()
    )
    for key in keys:
        kept = kept.where(valid_key(F.col(key)))
    return kept.select(*[
        number(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "double"
        else F.col(f.name).try_cast(f.dataType).alias(f.name)
        for f in STAGED_BUYS.schema
    ])


def newest_first(staged: DataFrame) -> DataFrame:
    """Staged buys by crisis, newest first, for presentation."""
    return staged.orderBy(F.asc("crisis_id"), F.desc("first_buy_timestamp"))


def stage_buys(
    events: DataFrame,
    pools: DataFrame,
    logs: DataFrame,
    transactions: DataFrame,
    history: DataFrame,
    options: StageOneOptions = StageOneOptions(),
) -> DataFrame:
    """The whole stage: one staged row per buy."""
    return stage_with_days(events, pools, logs, transactions, history, options)[0]


def stage_with_days(
    events: DataFrame,
    pools: DataFrame,
    logs: DataFrame,
    transactions: DataFrame,
    history: DataFrame,
    options: StageOneOptions = StageOneOptions(),
) -> tuple[DataFrame, pricing.BuyDays]:
    """Staged buys, and their days as measured, which stage two need not measure again.

    Pricing needs the days of all buys before it can price the first one, so the few buys found are
    stored once instead of reading the logs twice.
    """
    buys = materialize(unpriced_buys(events, pools, logs, transactions, options), "buys", compact=True)
    days = pricing.buy_days(buys)
    priced = pricing.price_buys(buys, history, options.clip_history, options.default_price, days=days)
    return format_buys(priced), days
