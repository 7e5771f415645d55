"""Stage two: from staged buys to profitable trades and the wallet leaderboard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from slumptrace.constants import MIN_PROFIT_PCT, RECOVERY_DAYS, TOP_WALLETS
from slumptrace.operators import profit
from slumptrace.operators.pricing import BuyDays
from slumptrace.operators.scale import materialize


@dataclass(frozen=True)
class StageTwoOptions:
    """Settings of stage two. A gain of three times the price is ``min_profit_pct=200``."""

    recovery_days: int = RECOVERY_DAYS
    min_profit_pct: float = MIN_PROFIT_PCT
    top_n: int = TOP_WALLETS


def profitable_trades(
    staged: DataFrame, history: DataFrame, options: StageTwoOptions = StageTwoOptions(), days: BuyDays | None = None
) -> DataFrame:
    """Staged buys that gained enough, in the columns of the trade table. ``days`` are those of the buys, if known."""
    pnl = profit.estimate_pnl(staged, history, options.recovery_days, days)
    return profit.format_trades(profit.profitable(pnl, options.min_profit_pct))


@dataclass(frozen=True)
class Outcome:
    """The results of stage two. All three read the stored trades."""

    trades: DataFrame
    board: DataFrame
    board_trades: DataFrame


def rank_wallets(
    staged: DataFrame, history: DataFrame, options: StageTwoOptions = StageTwoOptions(), days: BuyDays | None = None
) -> Outcome:
    """Trades, leaderboard and the trades behind it; trades and leaderboard are computed once."""
    return board_of(materialize(profitable_trades(staged, history, options, days), "trades"), options)


def board_of(trades: DataFrame, options: StageTwoOptions = StageTwoOptions()) -> Outcome:
    """Leaderboard of stored trades, and the trades behind it.

    A board of a few rows is brought to the driver once and stays there; a long one is stored.
    """
    found = profit.leaderboard(trades, options.top_n)
    if options.top_n <= 1_000:
        board = trades.sparkSession.createDataFrame(found.collect(), found.schema)
    else:
        board = materialize(found, "board")
    return Outcome(trades, board, profit.leaderboard_trades(trades, board))
