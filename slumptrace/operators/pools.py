"""Which pools trade a crisis token, and how the pool dimension is built from pair-created logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slumptrace.constants import BASE_TOKENS, CHAIN, UNKNOWN_SYMBOL
from slumptrace.functions.logs import (
    PROTOCOLS, Protocol, pair_address, prefixed_address, protocol_name, topic_address,
)
from slumptrace.functions.values import well_formed_address
from slumptrace.operators.scale import number_rows, small_side
from slumptrace.sources.readers import factory_logs


def crisis_pools(pools: DataFrame, events: DataFrame, event_rows: int | None = None) -> DataFrame:
    """Pool × crisis for every pool with the crisis token on either side.

    Each pool is listed once per distinct token of its pair, which turns the either-or condition into an
    equi join. ``event_rows`` is the number of crises, if known.
    """
    by_token = pools.select(
        "*", F.explode(F.array_distinct(F.array("token0_address", "token1_address"))).alias("crisis_token")
    )
    windows = events.withColumnRenamed("token_address", "crisis_token")
    return by_token.join(small_side(windows, event_rows), "crisis_token").select(
        "pool_address", "token0_address", "token1_address", "dex_protocol",
        *[c for c in ("token0_decimals", "token1_decimals") if c in pools.columns],
        "crisis_id", "crisis_token", "window_start_date", "window_end_date", "crisis_name",
    ).distinct()


def crisis_symbols(events: DataFrame) -> DataFrame:
    """``CRISIS1``, ``CRISIS2``, … for the distinct crisis tokens in address order."""
    tokens = events.select(F.lower("token_address").alias("token_address")).distinct()
    numbered = number_rows(tokens, [F.col("token_address")], name="position")
    return numbered.select("token_address", F.concat(F.lit("CRISIS"), "position").alias("symbol"))


def base_tokens(events: DataFrame, symbols: Mapping[str, str] = BASE_TOKENS) -> DataFrame:
    """The base tokens as a frame."""
    rows = [(address.lower(), symbol) for address, symbol in symbols.items()]
    return events.sparkSession.createDataFrame(rows, "token_address string, symbol string")


def token_roles(events: DataFrame, base: DataFrame) -> DataFrame:
    """Symbol and role of every crisis and base token. The name of a base token wins."""
    both = crisis_symbols(events).select(
        "token_address", F.col("symbol").alias("crisis_symbol"), F.lit(None).cast("string").alias("base_symbol")
    ).unionByName(
        base.select("token_address", F.lit(None).cast("string").alias("crisis_symbol"),
                    F.col("symbol").alias("base_symbol"))
    )
    return both.groupBy("token_address").agg(
        F.max("crisis_symbol").alias("crisis_symbol"), F.max("base_symbol").alias("base_symbol")
    ).select(
        "token_address",
        F.coalesce("base_symbol", "crisis_symbol").alias("symbol"),
        F.col("crisis_symbol").isNotNull().alias("is_crisis"),
        F.col("base_symbol").isNotNull().alias("is_base"),
    )


def with_symbols(pairs: DataFrame, roles: DataFrame) -> DataFrame:
    """Add symbol and role of both tokens; tokens without a role are called ``UNK``."""
    lookup = small_side(roles)
    for side in ("token0", "token1"):
        named = lookup.select(
            F.col("token_address").alias(f"{side}_address"),
            F.col("symbol").alias(f"{side}_symbol"),
            F.col("is_crisis").alias(f"{side}_is_crisis"),
            F.col("is_base").alias(f"{side}_is_base"),
        )
        pairs = pairs.join(named, f"{side}_address", "left")
    return pairs.fillna(UNKNOWN_SYMBOL, ["token0_symbol", "token1_symbol"]).fillna(
        False, ["token0_is_crisis", "token0_is_base", "token1_is_crisis", "token1_is_base"]
    )


def decode_pairs(logs: DataFrame, protocols: Sequence[Protocol] = PROTOCOLS) -> DataFrame:
    """Pool, tokens and protocol out of pair-created logs; malformed addresses are dropped."""
    decoded = logs.select(
        protocol_name(F.col("address"), protocols).alias("dex_protocol"),
        prefixed_address(topic_address(F.col("topics"), 1)).alias("token0_address"),
        prefixed_address(topic_address(F.col("topics"), 2)).alias("token1_address"),
        prefixed_address(pair_address(F.col("data"))).alias("pool_address"),
    )
    for column in ("token0_address", "token1_address", "pool_address"):
        decoded = decoded.where(well_formed_address(F.col(column)))
    return decoded


def build_pools(
    logs: DataFrame,
    events: DataFrame,
    base: DataFrame | None = None,
    protocols: Sequence[Protocol] = PROTOCOLS,
    since: str | None = None,
) -> DataFrame:
    """The pool dimension: pairs of a crisis token with a base token, in either order, made from ``since`` on if given."""
    base = base_tokens(events) if base is None else base
    topics = sorted({p.pair_topic for p in protocols})
    pairs = decode_pairs(factory_logs(logs, [p.factory for p in protocols], topics, since), protocols)
    named = with_symbols(pairs, token_roles(events, base))
    crossed = named.where(
        (F.col("token0_is_crisis") & F.col("token1_is_base")) | (F.col("token0_is_base") & F.col("token1_is_crisis"))
    )
    return crossed.select(
        "pool_address",
        F.concat("token0_symbol", F.lit("-"), "token1_symbol", F.lit(" Pool")).alias("pool_name"),
        "token0_address", "token0_symbol", "token1_address", "token1_symbol", "dex_protocol",
        F.lit(CHAIN).alias("chain"),
    )
