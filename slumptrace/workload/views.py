"""The input tables of the analysis, derived from the test tables.

An order stands for a transaction, a line item for a log, a supplier for a pool, a nation for a token and
a customer for a wallet. The text serves both engines: Spark reads the test tables through the braces,
DuckDB reads them by name.
"""

from __future__ import annotations

from functools import cached_property
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from slumptrace.constants import PAIR_CREATED_TOPIC, PAIR_FACTORY, SWAP_TOPIC, ZERO_ADDRESS
from slumptrace.operators.scale import materialize
from slumptrace.sources.readers import load, mark_lower


# The keys of the test tables are never null. Saying so spares a null check that computes the key again.
def _address(expr: str) -> str:
    return f"coalesce(concat('0x', lpad(lower(hex({expr})), 40, '0')), '')"


def _topic(expr: str) -> str:
    return f"coalesce(concat('0x', lpad(lower(hex({expr})), 64, '0')), '')"


def _word(expr: str) -> str:
    # Times 2^64, so that amounts are wider than 64 bits.
    return f"lpad(concat(lower(hex(cast(floor({expr}) as bigint))), '0000000000000000'), 64, '0')"


_ZERO_WORD = "repeat('0', 64)"
_FIRST_DAY = "date '1996-01-01'"
_SECOND_TOKEN = "(s_nationkey + 1 + s_suppkey % 7) % 25 + 4096"
BASE_NATIONS = (12, 13, 14, 24)

VIEWS = {
    "fx_pools": f"""
        SELECT {_address('s_suppkey + 1048576')} AS pool_address,
               {_address('s_nationkey + 4096')} AS token0_address,
               {_address(_SECOND_TOKEN)} AS token1_address,
               CASE WHEN s_suppkey % 10 = 9 THEN 'SushiSwap' ELSE 'Uniswap V2' END AS dex_protocol,
               s_name AS pool_name,
               'ethereum' AS chain
        FROM {{supplier}}""",
    "fx_events": f"""
        SELECT concat('crisis_', lpad(cast(n_nationkey + 1 as string), 3, '0')) AS crisis_id,
               {_address('n_nationkey + 4096')} AS token_address,
               n_name AS crisis_name,
               {_FIRST_DAY} + cast(n_nationkey * 60 as int) AS crisis_date,
               {_FIRST_DAY} + cast(n_nationkey * 60 as int) AS window_start_date,
               {_FIRST_DAY} + cast(n_nationkey * 60 + 30 + n_nationkey * 5 as int) AS window_end_date,
               {_FIRST_DAY} + cast(n_nationkey * 60 as int) AS dt
        FROM {{nation}} WHERE n_regionkey < 3""",
    "fx_transactions": f"""
        SELECT {_topic('o_orderkey')} AS hash,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL
                    WHEN o_orderkey % 19 = 0 THEN '{ZERO_ADDRESS}'
                    ELSE {_address('o_custkey + 65536')} END AS from_address
        FROM {{orders}}""",
    "fx_logs": f"""
        SELECT l_shipdate + l_linenumber * interval '3' hour + l_orderkey % 60 * interval '1' minute AS block_timestamp,
               {_topic('l_orderkey')} AS transaction_hash,
               cast(l_linenumber as bigint) AS log_index,
               {_address('l_suppkey + 1048576')} AS address,
               {{list}}CASE WHEN l_linestatus = 'F' OR l_linenumber < 5 THEN '{SWAP_TOPIC}'
                    ELSE concat('0x', repeat('1', 64)) END{{end}} AS topics,
               CASE WHEN l_linenumber % 2 = 0
                    THEN concat('0x', {_ZERO_WORD}, {_word('l_extendedprice')}, {_word('l_quantity')}, {_ZERO_WORD})
                    ELSE concat('0x', {_word('l_extendedprice')}, {_ZERO_WORD}, {_ZERO_WORD}, {_word('l_quantity')})
               END AS data
        FROM {{lineitem}}""",
    "fx_prices": f"""
        SELECT {_address('s_nationkey + 4096')} AS token_address,
               cast(l_shipdate as date) AS dt,
               max(l_extendedprice) AS price_usd,
               sum(l_quantity) AS liquidity_usd
        FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey
        GROUP BY s_nationkey, cast(l_shipdate as date)""",
    "fx_factory_logs": f"""
        SELECT cast('2021-06-01 00:00:00' as timestamp) AS block_timestamp,
               CASE WHEN s_suppkey % 6 = 5 THEN concat('0x', repeat('a', 40)) ELSE '{PAIR_FACTORY}' END AS address,
               {{list}}'{PAIR_CREATED_TOPIC}', {_topic('s_nationkey + 4096')}, {_topic(_SECOND_TOKEN)}{{end}} AS topics,
               concat('0x', lpad(lower(hex(s_suppkey + 1048576)), 64, '0'),
                      lpad(lower(hex(s_suppkey)), 64, '0')) AS data
        FROM {{supplier}}""",
    # Swap logs of which most payloads are missing, too short, or no hex, and some addresses are in upper case.
    "fx_broken_logs": f"""
        SELECT block_timestamp, transaction_hash, log_index,
               CASE WHEN log_index % 2 = 0 THEN concat('0x', upper(substr(address, 3, 40))) ELSE address END AS address, topics,
               CASE log_index WHEN 1 THEN NULL WHEN 2 THEN '0x' WHEN 3 THEN substr(data, 1, 200)
                    WHEN 4 THEN concat(substr(data, 1, 180), 'zz', substr(data, 183, 76))
                    WHEN 5 THEN concat(substr(data, 1, 150), '.', substr(data, 152, 107)) ELSE data END AS data
        FROM ({{fx_logs}})""",
    # Pair-created logs of which some name no proper address.
    "fx_broken_pairs": f"""
        SELECT block_timestamp, upper(address) AS address,
               {{list}}'{PAIR_CREATED_TOPIC}', CASE WHEN s % 4 = 0 THEN substr(token0, 1, 60) ELSE token0 END, token1{{end}} AS topics,
               CASE s % 5 WHEN 0 THEN NULL WHEN 1 THEN substr(data, 1, 60) ELSE data END AS data
        FROM (SELECT cast('2021-06-01 00:00:00' as timestamp) AS block_timestamp, '{PAIR_FACTORY}' AS address, s_suppkey AS s,
                     {_topic('s_nationkey + 4096')} AS token0, {_topic(_SECOND_TOKEN)} AS token1,
                     concat('0x', lpad(lower(hex(s_suppkey + 1048576)), 64, '0'), lpad(lower(hex(s_suppkey)), 64, '0')) AS data
              FROM {{supplier}})""",
    # Priced buys of which some have no usable key, time or number.
    "fx_priced": f"""
        SELECT CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN 'nan' WHEN 3 THEN NULL ELSE 'crisis_001' END AS crisis_id,
               CASE WHEN l_orderkey % 11 = 0 THEN 'nan' ELSE {_address('l_partkey')} END AS wallet_address,
               CASE WHEN l_orderkey % 13 = 0 THEN '' ELSE {_address('l_suppkey')} END AS token_address,
               CASE WHEN l_orderkey % 7 <> 0 THEN cast(l_shipdate as timestamp) END AS first_buy_timestamp,
               CASE WHEN l_quantity > 40 THEN 'unknown' ELSE cast(cast(l_quantity as int) as string) END AS first_buy_price,
               l_extendedprice AS total_amount_bought, l_tax AS total_usd_spent
        FROM {{lineitem}}""",
    # Pools of the dimension that no log has ever named.
    "fx_quiet_pools": f"""
        SELECT {_address('p_partkey + 16777216')} AS pool_address
        FROM {{part}} WHERE p_size = 1""",
    "fx_base_tokens": f"""
        SELECT {_address('n_nationkey + 4096')} AS token_address, n_name AS symbol
        FROM {{nation}} WHERE n_nationkey IN {BASE_NATIONS}""",
    # A staged table with every kind of broken row, for the validation rules.
    "fx_broken_buys": f"""
        SELECT CASE WHEN l_linenumber <> 7 THEN 'crisis_001' END AS crisis_id,
               CASE WHEN l_orderkey % 17 <> 0 THEN {_address('l_partkey')} END AS wallet_address,
               {_address('l_suppkey')} AS token_address,
               CASE WHEN l_quantity > 2 THEN l_shipdate END AS first_buy_timestamp,
               l_tax - 0.01 AS first_buy_price,
               CASE WHEN l_linenumber <> 3 THEN l_quantity - 5 END AS total_amount_bought,
               l_extendedprice AS total_usd_spent,
               CASE WHEN l_linenumber = 6 THEN NULL ELSE cast(1 + l_orderkey % 2 as bigint) END AS num_transactions
        FROM {{lineitem}}""",
}
TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle_view(name: str) -> str:
    """A view as text for DuckDB."""
    logs = VIEWS["fx_logs"].format(list="[", end="]", lineitem="lineitem")
    return VIEWS[name].format(list="[", end="]", fx_logs=logs, **{t: t for t in TEST_TABLES})


class Fixture:
    """The views over the test tables of one scale, as frames."""

    # The test tables never change, so their schemas are read once per process, as a catalog would keep them.
    _schemas: ClassVar[dict[str, StructType]] = {}

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._raw: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        if table not in self._raw:
            path = f"{self.folder.rstrip('/')}/{table}.parquet"
            if path not in self._schemas:
                self._schemas[path] = load(self.spark, path).schema
            self._raw[table] = self.spark.read.schema(self._schemas[path]).parquet(path)
        return self._raw[table]

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name].replace("{fx_logs}", VIEWS["fx_logs"])
        tables = {t: self.raw(t) for t in TEST_TABLES if f"{{{t}}}" in text}
        # Only the table names are left for the session to fill in.
        text = text.replace("{list}", "array(").replace("{end}", ")")
        return self.spark.sql(text, **tables)

    @cached_property
    def pools(self) -> DataFrame:
        return self.view("fx_pools")

    @cached_property
    def events(self) -> DataFrame:
        return self.view("fx_events")

    @cached_property
    def transactions(self) -> DataFrame:
        return self.view("fx_transactions")

    @cached_property
    def logs(self) -> DataFrame:
        # Stands for stored logs, whose addresses are in lower case.
        return mark_lower(self.view("fx_logs"), "address")

    @cached_property
    def prices(self) -> DataFrame:
        return self.view("fx_prices")

    @cached_property
    def stored_prices(self) -> DataFrame:
        """The price history as a stored table, as both stages expect it."""
        return materialize(self.prices, "prices")

    @cached_property
    def factory_logs(self) -> DataFrame:
        return self.view("fx_factory_logs")

    @cached_property
    def base_tokens(self) -> DataFrame:
        return self.view("fx_base_tokens")

    @cached_property
    def broken_buys(self) -> DataFrame:
        return self.view("fx_broken_buys")
