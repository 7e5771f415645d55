"""Estimated profit per buy, and the wallets that gained most."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slumptrace.constants import MIN_PROFIT_PCT, RECOVERY_DAYS, TOP_WALLETS
from slumptrace.functions.values import number, pct_change, valid_key
from slumptrace.operators.pricing import BuyDays, peak_after
from slumptrace.operators.scale import number_rows, small_side
from slumptrace.schemas import PROFITABLE_TRADES


def estimate_pnl(
    buys: DataFrame, history: DataFrame, recovery_days: int = RECOVERY_DAYS, days: BuyDays | None = None
) -> DataFrame:
    """Profit of each staged buy if it had been sold at the peak of the recovery period.

    Buys at a price of 0 or less, and buys no price follows, have none.
    """
    buy, peak = F.col("first_buy_price"), F.col("peak_price")
    return peak_after(buys, history, recovery_days, days=days).where(buy > 0).select(
        "crisis_id", "wallet_address", "token_address",
        buy.alias("buy_price"),
        peak.alias("peak_recovery_price"),
        pct_change(buy, peak).alias("estimated_profit_pct"),
        ((peak - buy) * F.col("total_amount_bought")).alias("estimated_profit_usd"),
        F.col("first_buy_timestamp").alias("buy_timestamp"),
        F.col("peak_date").cast("timestamp").alias("peak_recovery_timestamp"),
        F.col("total_amount_bought").alias("amount_bought"),
        F.col("total_usd_spent").alias("original_usd_spent"),
    )


def profitable(pnl: DataFrame, min_pct: float = MIN_PROFIT_PCT) -> DataFrame:
    """Trades that gained at least ``min_pct`` percent."""
    return pnl.where(F.col("estimated_profit_pct") >= min_pct)


def format_trades(trades: DataFrame) -> DataFrame:
    """The columns of the trade table, complete rows only."""
    columns = [
        number(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "double"
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in PROFITABLE_TRADES.schema
    ]
    keys = [valid_key(F.col(c)) for c in ("crisis_id", "wallet_address", "token_address")]
    return trades.select(*columns).na.drop().where(keys[0] & keys[1] & keys[2])


def best_first(trades: DataFrame) -> DataFrame:
    """Trades by percent gained, for presentation."""
    return trades.orderBy(F.desc("estimated_profit_pct"))


def leaderboard(trades: DataFrame, top_n: int = TOP_WALLETS) -> DataFrame:
    """The wallets with the highest total profit, ranked.

    Totals are rounded before ranking, half to even; equal totals are ranked by address.
    """
    totals = trades.groupBy("wallet_address").agg(
        F.bround(F.sum("estimated_profit_usd"), 2).alias("total_profit_usd"),
        F.bround(F.avg("estimated_profit_pct"), 2).alias("avg_profit_pct"),
        F.count("crisis_id").alias("num_trades"),
    )
    best = [F.desc("total_profit_usd"), F.asc("wallet_address")]
    # Only the top rows reach the unpartitioned window.
    return totals.orderBy(*best).limit(top_n).select(
        F.row_number().over(Window.orderBy(*best)).alias("rank"),
        "wallet_address", "total_profit_usd", "avg_profit_pct", "num_trades",
    )


def leaderboard_trades(trades: DataFrame, board: DataFrame) -> DataFrame:
    """The trades behind a leaderboard, numbered within each wallet by percent gained."""
    size, largest = board.agg(F.count("*"), F.max("num_trades")).first()
    listed = trades.join(small_side(board.select("rank", "wallet_address"), size), "wallet_address")
    order = [F.desc("estimated_profit_pct"), F.asc("buy_timestamp")] + [
        F.asc(c) for c in ("crisis_id", "token_address", "estimated_profit_usd")
    ]
    return number_rows(listed, order, within=["rank", "wallet_address"], name="trade_no", largest=largest or 0).select(
        "rank", "wallet_address", "trade_no", "crisis_id", "token_address",
        "buy_price", "peak_recovery_price", "estimated_profit_pct", "estimated_profit_usd",
    )


def pnl_summary(trades: DataFrame, top_n: int = TOP_WALLETS) -> DataFrame:
    """One row over all trades. Listed wallets are those a leaderboard of ``top_n`` shows."""
    return trades.agg(
        F.least(F.count_distinct("wallet_address"), F.lit(top_n)).cast("bigint").alias("listed_wallets"),
        F.count("*").alias("trades"),
        F.sum("estimated_profit_usd").alias("total_profit_usd"),
        F.avg("estimated_profit_pct").alias("avg_profit_pct"),
    )


def kept_ratio(pnl: DataFrame, min_pct: float = MIN_PROFIT_PCT) -> DataFrame:
    """How many of all estimated trades pass the threshold, and their mean gain before it."""
    kept = F.count_if(F.col("estimated_profit_pct") >= min_pct)
    return pnl.agg(
        F.count("*").alias("estimated_trades"),
        kept.alias("kept_trades"),
        F.try_divide(kept, F.count("*")).alias("kept_ratio"),
        F.avg("estimated_profit_pct").alias("avg_profit_pct"),
    )
