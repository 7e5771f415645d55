"""The seven tables of the data model, declared once and used for DDL, sinks and empty frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)


@dataclass(frozen=True)
class Table:
    """A table's name, columns and on-disk layout."""

    name: str
    comment: str
    schema: StructType
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    # Rows are hashed into so many buckets by the first clustering column, and sorted by all in each.
    buckets: int = 0

    @property
    def addresses(self) -> list[str]:
        """The columns that hold addresses, which are stored in lower case."""
        return [f.name for f in self.schema if f.name.endswith("_address")]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


def _column(name: str, kind: DataType, comment: str, required: bool = False) -> StructField:
    return StructField(name, kind, not required, {"comment": comment})


_TEXT, _DOUBLE, _LONG, _DATE, _TIME = StringType(), DoubleType(), LongType(), DateType(), TimestampType()

CRISIS_EVENTS = Table(
    "crisis_events_with_window",
    "Crises and the days on which buying against them counts",
    StructType([
        _column("crisis_id", _TEXT, "Identifier of the crisis", True),
        _column("token_address", _TEXT, "Token that crashed", True),
        _column("crisis_date", _DATE, "Day of the crash", True),
        _column("crisis_name", _TEXT, "Readable name"),
        _column("window_start_date", _DATE, "First day of the buy window", True),
        _column("window_end_date", _DATE, "Last day of the buy window", True),
        _column("dt", _DATE, "Partition day"),
    ]),
    partition_by=("dt",),
)

POOLS = Table(
    "dim_dex_pools",
    "Liquidity pools with their token pair and protocol",
    StructType([
        _column("pool_address", _TEXT, "Contract address of the pool", True),
        _column("pool_name", _TEXT, "Both symbols and the word Pool"),
        _column("token0_address", _TEXT, "First token of the pair", True),
        _column("token0_symbol", _TEXT, "Symbol of the first token"),
        _column("token1_address", _TEXT, "Second token of the pair", True),
        _column("token1_symbol", _TEXT, "Symbol of the second token"),
        _column("dex_protocol", _TEXT, "Protocol whose factory created the pool"),
        _column("chain", _TEXT, "Chain the pool lives on", True),
    ]),
)

PRICES = Table(
    "dim_token_price_history",
    "One row of market data per token and day",
    StructType([
        _column("token_address", _TEXT, "Token", True),
        _column("price_usd", _DOUBLE, "Closing price"),
        _column("volume_24h_usd", _DOUBLE, "Traded volume of the day"),
        _column("market_cap_usd", _DOUBLE, "Market capitalisation"),
        _column("price_change_24h_pct", _DOUBLE, "Change against the day before, in percent"),
        _column("liquidity_usd", _DOUBLE, "Liquidity over all pools"),
        _column("high_24h_usd", _DOUBLE, "Highest price of the day"),
        _column("low_24h_usd", _DOUBLE, "Lowest price of the day"),
        _column("dt", _DATE, "Day of the quote"),
    ]),
    # Prices are looked up by token, so a token's days lie together. Partitions by day as well would multiply the
    # files by the days, and every lookup would open all of them.
    cluster_by=("token_address", "dt"),
    buckets=16,
)

STAGED_BUYS = Table(
    "stg_crisis_buyers",
    "Buys of crashed tokens inside their crisis window, one row per swap",
    StructType([
        _column("crisis_id", _TEXT, "Crisis the buy belongs to", True),
        _column("wallet_address", _TEXT, "Buyer", True),
        _column("token_address", _TEXT, "Token bought", True),
        _column("first_buy_timestamp", _TIME, "Time of the buy", True),
        _column("first_buy_price", _DOUBLE, "Daily price valid at the buy"),
        _column("total_amount_bought", _DOUBLE, "Tokens received"),
        _column("total_usd_spent", _DOUBLE, "Tokens received times price"),
        _column("num_transactions", _LONG, "Swaps in this row, always 1"),
    ]),
)

PROFITABLE_TRADES = Table(
    "stg_profitable_flippers",
    "Staged buys whose token rose enough afterwards",
    StructType([
        _column("crisis_id", _TEXT, "Crisis the buy belongs to", True),
        _column("wallet_address", _TEXT, "Buyer", True),
        _column("token_address", _TEXT, "Token bought", True),
        _column("buy_price", _DOUBLE, "Price paid"),
        _column("peak_recovery_price", _DOUBLE, "Highest price in the recovery period"),
        _column("estimated_profit_pct", _DOUBLE, "Gain at the peak, in percent"),
        _column("estimated_profit_usd", _DOUBLE, "Gain at the peak, in dollars"),
        _column("buy_timestamp", _TIME, "Time of the buy"),
        _column("peak_recovery_timestamp", _TIME, "Midnight of the first day at the peak price"),
    ]),
)

WALLET_LABELS = Table(
    "dim_wallet_labels",
    "Label and track record per wallet",
    StructType([
        _column("wallet_address", _TEXT, "Labelled wallet", True),
        _column("label_value", _TEXT, "Label", True),
        _column("num_crisis_events", _LONG, "Crises the wallet bought in"),
        _column("total_profited_crises", _LONG, "Crises the wallet gained from"),
        _column("success_rate", _DOUBLE, "Gained crises over joined crises"),
        _column("total_pnl_pct", _DOUBLE, "Estimated gain over money spent, in percent"),
        _column("total_pnl_usdt", _DOUBLE, "Estimated gain in dollars"),
        _column("last_updated_timestamp", _TIME, "When the label was computed", True),
    ]),
)

REALISED_PROFIT = Table(
    "fct_realised_profit",
    "What wallets made by selling again within the recovery period, at average cost",
    StructType([
        _column("wallet_address", _TEXT, "Wallet", True),
        _column("token_address", _TEXT, "Token bought and sold", True),
        _column("bought_amount", _DOUBLE, "Tokens bought"),
        _column("sold_amount", _DOUBLE, "Tokens sold within the recovery period of a buy"),
        _column("closed_amount", _DOUBLE, "Tokens sold that were held"),
        _column("realised_profit_usd", _DOUBLE, "Sum of price over average cost of what was closed"),
    ]),
)

TABLES = {
    t.name: t
    for t in (CRISIS_EVENTS, POOLS, PRICES, STAGED_BUYS, PROFITABLE_TRADES, WALLET_LABELS, REALISED_PROFIT)
}
