"""One query per operator, over whole tables; every one takes (spark, folder) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slumptrace.functions.logs import PROTOCOLS, Protocol, register_sql_functions
from slumptrace.operators import crisis, labels, pools, pricing, profit, quality, swaps
from slumptrace.operators.scale import materialize, staging_folder
from slumptrace.plans import jobs, stage_one, stage_two
from slumptrace.plans.stage_one import StageOneOptions
from slumptrace.schemas import CRISIS_EVENTS, PRICES, STAGED_BUYS
from slumptrace.sources import catalog, readers
from slumptrace.sources.sinks import write_table
from slumptrace.workload.views import TEST_TABLES, Fixture

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The range of the fixture's crisis windows, as the log scan takes it.
SCAN_FROM, SCAN_UNTIL = "1996-01-01", "1998-06-01"
LATEST = 5_000
TWO_PROTOCOLS = (*PROTOCOLS, Protocol("SushiSwap", "0x" + "a" * 40))
_LOG_COLUMNS = ["block_timestamp", "transaction_hash", "log_index", "pool_address", "data"]


def query(build: Callable[[Fixture], DataFrame]) -> Callable[[Fixture], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Fixture(spark, folder))
    return build


def _own_database(fx: Fixture) -> str:
    """A new database in the staging folder."""
    database = f"own_{uuid4().hex}"
    catalog.ensure_database(fx.spark, database, f"{staging_folder(fx.spark)}/{database}")
    return database


def _times(df: DataFrame) -> DataFrame:
    """Times without zone become instants, the type the tables declare."""
    return df.withColumns({
        name: F.col(name).cast("timestamp") for name, kind in df.dtypes if kind == "timestamp_ntz"
    })


# Scans


@query
def scan_crisis_events(fx: Fixture) -> DataFrame:
    return readers.crisis_events(fx.events)


@query
def scan_pool_names(fx: Fixture) -> DataFrame:
    return readers.pool_names(fx.pools)


@query
def scan_price_history(fx: Fixture) -> DataFrame:
    span = stage_one.crisis_span(fx.events)
    return readers.prices(fx.prices, fx.events, span.first, span.last, span.count)


@query
def scan_factory_logs(fx: Fixture) -> DataFrame:
    return readers.factory_logs(fx.factory_logs).select("block_timestamp", "address", "data")


@query
def scan_swap_logs(fx: Fixture) -> DataFrame:
    keys = pools.crisis_pools(readers.pools(fx.pools), readers.crisis_events(fx.events))
    return _times(readers.swap_logs(fx.logs, SCAN_FROM, SCAN_UNTIL, keys).select(*_LOG_COLUMNS))


@query
def latest_swaps_topn(fx: Fixture) -> DataFrame:
    return _times(swaps.latest(readers.swap_logs(fx.logs).select(*_LOG_COLUMNS), LATEST))


# Stage one


@query
def crisis_pools(fx: Fixture) -> DataFrame:
    return pools.crisis_pools(readers.pools(fx.pools), readers.crisis_events(fx.events))


@query
def swap_sender_join(fx: Fixture) -> DataFrame:
    found = readers.swap_logs(fx.logs).drop("topics", "data", "swap_topic")
    return _times(swaps.by_valid_wallets(swaps.with_sender(found, readers.senders(fx.transactions))))


@query
def swap_sender_join_stored(fx: Fixture) -> DataFrame:
    """The same from transactions that are stored in buckets of their hash."""
    database = _own_database(fx)
    fx.transactions.write.parquet(path := f"{staging_folder(fx.spark)}/transactions-{uuid4().hex}")
    jobs.store_transactions(fx.spark, database, path, buckets=16)
    found = readers.swap_logs(fx.logs).drop("topics", "data", "swap_topic")
    senders = readers.senders(fx.spark.table(f"{database}.stored_transactions"))
    return _times(swaps.by_valid_wallets(swaps.with_sender(found, senders)))


def _window_swaps(fx: Fixture) -> DataFrame:
    return stage_one.window_swaps(fx.events, fx.pools, fx.logs)


@query
def swaps_in_window(fx: Fixture) -> DataFrame:
    return _times(_window_swaps(fx).select(
        "crisis_id", "crisis_token", "token0_address", "token1_address", "dex_protocol", *_LOG_COLUMNS
    ))


def _decoded(fx: Fixture, decode: str) -> DataFrame:
    amount0, amount1 = swaps.out_amounts(decode, protocols=TWO_PROTOCOLS)
    return _window_swaps(fx).select(
        "crisis_id", "transaction_hash", "log_index", "pool_address",
        amount0.alias("amount0"), amount1.alias("amount1"), swaps.bought_amount(decode).alias("bought_amount"),
    )


@query
def decode_amounts_abi(fx: Fixture) -> DataFrame:
    return _decoded(fx, "abi")


@query
def decode_amounts_shifted(fx: Fixture) -> DataFrame:
    return _decoded(fx, "shifted")


@query
def broken_payloads(fx: Fixture) -> DataFrame:
    """Swaps whose payload is missing, short or no hex have no amount, and are no buys; addresses may be in any case."""
    amount0, amount1 = swaps.out_amounts("abi", protocols=TWO_PROTOCOLS)
    found = readers.swap_logs(fx.view("fx_broken_logs")).join(readers.pools(fx.pools), "pool_address")
    return found.select("transaction_hash", "log_index", "pool_address", amount0.alias("amount0"), amount1.alias("amount1"))


def _buys(fx: Fixture, **options) -> DataFrame:
    return stage_one.unpriced_buys(fx.events, fx.pools, fx.logs, fx.transactions, StageOneOptions(**options))


@query
def crisis_buys(fx: Fixture) -> DataFrame:
    return _buys(fx)


@query
def multi_protocol_buys(fx: Fixture) -> DataFrame:
    return _buys(fx, protocols=TWO_PROTOCOLS)


def _staged(fx: Fixture, history: DataFrame, **options) -> DataFrame:
    return stage_one.stage_buys(
        fx.events, fx.pools, fx.logs, fx.transactions, history, StageOneOptions(**options)
    )


_PRICED = [
    "crisis_id", "wallet_address", "token_address", "first_buy_timestamp", "first_buy_price", "total_amount_bought",
]


@query
def asof_price_clipped(fx: Fixture) -> DataFrame:
    return pricing.price_buys(materialize(_buys(fx), "buys"), fx.prices, clip_history=True).select(*_PRICED)


@query
def asof_price_full(fx: Fixture) -> DataFrame:
    return pricing.price_buys(materialize(_buys(fx), "buys"), fx.prices, clip_history=False).select(*_PRICED)


@query
def stage_buys(fx: Fixture) -> DataFrame:
    return _staged(fx, fx.prices)


@query
def format_broken_buys(fx: Fixture) -> DataFrame:
    """Rows without a usable key or time are dropped, and what is no number becomes null."""
    return stage_one.format_buys(fx.view("fx_priced"))


@query
def stage_buys_shifted(fx: Fixture) -> DataFrame:
    return _staged(fx, fx.prices, decode="shifted")


@query
def stage_buys_latest(fx: Fixture) -> DataFrame:
    return _staged(fx, fx.prices, start=SCAN_FROM, end=SCAN_UNTIL, latest=LATEST)


@query
def asof_price_stored(fx: Fixture) -> DataFrame:
    """As-of prices over the declared price table, whose buckets stay where they are."""
    database = _own_database(fx)
    write_table(fx.prices, database, PRICES, fill_missing=True)
    history = readers.load_table(fx.spark, database, PRICES)
    return pricing.price_buys(materialize(_buys(fx), "buys"), history, clip_history=False).select(*_PRICED)


# Stage two


@query
def peak_after_buy(fx: Fixture) -> DataFrame:
    buys = materialize(_buys(fx), "buys")
    return pricing.peak_after(buys, fx.prices).select(
        "crisis_id", "wallet_address", "token_address", "first_buy_timestamp", "peak_price", "peak_date"
    )


def _stored_stage_one(fx: Fixture) -> tuple[DataFrame, DataFrame, pricing.BuyDays]:
    """Staged buys and price history as stage two finds them, stored, and the days of the buys."""
    history = fx.stored_prices
    staged, days = stage_one.stage_with_days(fx.events, fx.pools, fx.logs, fx.transactions, history)
    return materialize(staged, "staged"), history, days


def _pnl(fx: Fixture) -> DataFrame:
    staged, history, days = _stored_stage_one(fx)
    return profit.estimate_pnl(staged, history, days=days)


def _trades(fx: Fixture) -> DataFrame:
    return profit.format_trades(profit.profitable(_pnl(fx)))


@query
def estimated_pnl(fx: Fixture) -> DataFrame:
    return _pnl(fx)


@query
def profitable_trades(fx: Fixture) -> DataFrame:
    return _trades(fx)


@query
def wallet_leaderboard(fx: Fixture) -> DataFrame:
    return profit.leaderboard(_trades(fx))


@query
def leaderboard_trades(fx: Fixture) -> DataFrame:
    staged, history, days = _stored_stage_one(fx)
    return stage_two.rank_wallets(staged, history, days=days).board_trades


@query
def top_multiples(fx: Fixture) -> DataFrame:
    """The top 100 by trades worth more than three times their price."""
    tripled = _pnl(fx).where(F.col("estimated_profit_pct") > 200.0)
    return profit.leaderboard(profit.format_trades(tripled), 100)


@query
def pnl_summary(fx: Fixture) -> DataFrame:
    summary = profit.pnl_summary(_trades(fx))
    return summary.withColumns({
        c: F.round(c, 2) for c in ("total_profit_usd", "avg_profit_pct")
    })


@query
def profit_kept_ratio(fx: Fixture) -> DataFrame:
    return profit.kept_ratio(_pnl(fx)).withColumns({
        "kept_ratio": F.round("kept_ratio", 6), "avg_profit_pct": F.round("avg_profit_pct", 2)
    })


# Pools


@query
def build_pools(fx: Fixture) -> DataFrame:
    return pools.build_pools(fx.factory_logs, fx.events, fx.base_tokens)


@query
def broken_pairs(fx: Fixture) -> DataFrame:
    """Pair-created logs with malformed addresses make no pool."""
    return pools.decode_pairs(readers.factory_logs(fx.view("fx_broken_pairs")))


@query
def token_symbols(fx: Fixture) -> DataFrame:
    """Every pool with the symbols of its pair, known or not."""
    named = pools.with_symbols(readers.pools(fx.pools), pools.token_roles(fx.events, fx.base_tokens))
    return named.select("pool_address", "token0_symbol", "token1_symbol")


@query
def sql_udf_decode(fx: Fixture) -> DataFrame:
    register_sql_functions(fx.spark)
    return fx.spark.sql(
        """SELECT extract_token_address(topics, 1) AS token0_address,
                  extract_token_address(topics, 2) AS token1_address,
                  extract_token_address(topics, 3) AS missing_address,
                  extract_v2_pair_address(data) AS pool_address,
                  is_known_factory(address) AS known_factory,
                  get_dex_protocol(address) AS dex_protocol
           FROM {logs}""",
        logs=fx.factory_logs,
    )


# Quality


@query
def price_at_offsets(fx: Fixture) -> DataFrame:
    return pricing.price_at_offsets(fx.events, fx.prices)


@query
def crisis_move_check(fx: Fixture) -> DataFrame:
    return quality.check_crisis_moves(fx.events, fx.prices)


@query
def crisis_move_summary(fx: Fixture) -> DataFrame:
    return quality.crisis_moves_summary(quality.check_crisis_moves(fx.events, fx.prices))


@query
def pool_activity(fx: Fixture) -> DataFrame:
    return _times(quality.pool_activity(fx.logs, fx.pools, "1999-01-01"))


@query
def pool_activity_all(fx: Fixture) -> DataFrame:
    return _times(quality.pool_activity(fx.logs, fx.pools))


# Pools of the factory logs, and pools that have no logs of their own.
def _activity(fx: Fixture) -> tuple[DataFrame, DataFrame]:
    made = pools.decode_pairs(readers.factory_logs(fx.factory_logs)).select("pool_address").union(fx.view("fx_quiet_pools"))
    return made, quality.pool_activity(fx.logs, made)


@query
def pool_usage(fx: Fixture) -> DataFrame:
    return _times(quality.pools_with_activity(*_activity(fx)))


@query
def pool_coverage(fx: Fixture) -> DataFrame:
    return quality.pool_coverage(*_activity(fx))


@query
def table_completeness(fx: Fixture) -> DataFrame:
    return quality.check_completeness({name: fx.raw(name) for name in TEST_TABLES})


@query
def distinct_counts(fx: Fixture) -> DataFrame:
    return quality.distinct_counts(fx.raw("lineitem"), "l_orderkey", "l_suppkey", "l_shipdate")


@query
def distinct_counts_sketched(fx: Fixture) -> DataFrame:
    """Exact counts of distinct values, and whether those from the sketches of all days are as close as stated."""
    columns = ("l_orderkey", "l_suppkey", "l_partkey")
    lines = fx.raw("lineitem")
    sketches = materialize(quality.daily_sketches(lines, "l_shipdate", *columns), "sketches")
    near = quality.distinct_estimates(sketches, *columns).select(
        F.col("row_count").alias("days_rows"), *[F.col(f"distinct_{c}").alias(f"near_{c}") for c in columns])
    # One row each.
    both = quality.distinct_counts(lines, *columns).unionByName(near, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return both.select("row_count", "days_rows", *[f"distinct_{c}" for c in columns], *[
        (F.abs(F.col(f"near_{c}") - F.col(f"distinct_{c}")) <= quality.SKETCH_BOUND * F.col(f"distinct_{c}")).alias(f"close_{c}")
        for c in columns])


@query
def sample_crises(fx: Fixture) -> DataFrame:
    """Two crises to look at, the same ones for everybody."""
    return quality.sample_rows(fx.events, 2, seed=7, key="crisis_id")


@query
def validate_buys(fx: Fixture) -> DataFrame:
    return quality.validate_buys(fx.broken_buys)


# Crises


@query
def buy_windows(fx: Fixture) -> DataFrame:
    crises = fx.events.select("token_address", "crisis_date", "crisis_name")
    return crisis.buy_windows(crises, F.length("crisis_name"))


@query
def first_crisis_order(fx: Fixture) -> DataFrame:
    return crisis.first_crisis_order(fx.events)


@query
def crisis_phase(fx: Fixture) -> DataFrame:
    return crisis.crisis_phase(fx.prices.select("token_address", "dt"), fx.events)


@query
def detect_crises(fx: Fixture) -> DataFrame:
    found = crisis.detect_crises(fx.prices)
    return found.withColumns({c: F.round(c, 6) for c in ("return_pct", "market_return_pct")})


_ROUNDED = ("return_pct", "market_return_pct", "drain_pct")


@query
def daily_median_move(fx: Fixture) -> DataFrame:
    """The median price of a day by narrowing, as for days of any size."""
    quotes = materialize(readers.prices(fx.prices), "quotes")
    return crisis.daily_median(quotes, "dt", "price_usd", most=0).withColumn("median", F.round("median", 6))


@query
def detect_crises_drain(fx: Fixture) -> DataFrame:
    return crisis.detect_crises(fx.prices, max_drain_pct=-60.0).withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query
def detected_crisis_buys(fx: Fixture) -> DataFrame:
    """From prices to crises, their windows, and the buys inside them."""
    found = materialize(crisis.detect_crises(fx.prices, max_return_pct=-50.0, max_excess_pct=-40.0), "crises")
    events = materialize(crisis.detected_events(found, 10), "detected")
    return stage_one.unpriced_buys(events, fx.pools, fx.logs, fx.transactions)


# Words


@query
def word_topk(fx: Fixture) -> DataFrame:
    """The ten most frequent words per corpus among those found more than 100 times."""
    words = fx.raw("documents").select(
        F.explode(F.split("text", " ")).alias("word"), F.col("source").alias("corpus")
    ).where("word <> ''").groupBy("word", "corpus").agg(F.count("*").alias("word_count"))
    return words.where("word_count > 100").orderBy(
        F.desc("word_count"), "word", "corpus"
    ).limit(10).select(F.lower("word").alias("word"), "word_count", "corpus")


# Sinks


@query
def write_roundtrip(fx: Fixture) -> DataFrame:
    database = _own_database(fx)
    write_table(_staged(fx, fx.prices), database, STAGED_BUYS, validate=quality.require_valid, on_empty="error")
    return readers.staged_buys(readers.load(fx.spark, f"{database}.{STAGED_BUYS.name}"))


@query
def catalog_tables(fx: Fixture) -> DataFrame:
    """The tables of a new database, before and after one is dropped, with the rows a declared one holds."""
    database = _own_database(fx)
    made = catalog.ensure_tables(fx.spark, database)
    write_table(fx.events, database, CRISIS_EVENTS)
    catalog.drop_table(fx.spark, database, PRICES.name)
    left = catalog.list_tables(fx.spark, database)
    tables = fx.spark.createDataFrame([(name, name in left) for name in made], "table_name string, kept boolean")
    rows = quality.check_completeness({name: fx.spark.table(f"{database}.{name}") for name in left})
    return tables.join(rows.select("table_name", "row_count"), "table_name", "left")


# Wallets


@query
def newest_buys(fx: Fixture) -> DataFrame:
    """The first ten staged buys as they are shown: by crisis, the newest first."""
    shown = stage_one.newest_first(_staged(fx, fx.prices)).limit(10)
    return shown.select("crisis_id", "first_buy_timestamp")


@query
def best_trades(fx: Fixture) -> DataFrame:
    """The first ten trades as they are shown: by percent gained."""
    return profit.best_first(_trades(fx)).limit(10).select(F.round("estimated_profit_pct", 6).alias("estimated_profit_pct"))


@query
def buyer_rollup(fx: Fixture) -> DataFrame:
    return labels.buyer_rollup(_staged(fx, fx.prices)).withColumns({
        "total_amount_bought": F.round("total_amount_bought", 6),
        "total_usd_spent": F.round("total_usd_spent", 2),
        "avg_buy_price": F.round("avg_buy_price", 6),
    })


@query
def wallet_labels(fx: Fixture) -> DataFrame:
    staged, history, days = _stored_stage_one(fx)
    estimates = profit.estimate_pnl(staged, history, days=days)
    return labels.wallet_labels(staged, estimates).drop("last_updated_timestamp").withColumns({
        c: F.round(c, 2) for c in ("success_rate", "total_pnl_pct", "total_pnl_usdt")
    })


@query
def buys_after_crash(fx: Fixture) -> DataFrame:
    return _buys(fx, hours=(12, 84))


def _realised(fx: Fixture, walk_rows: int | None = None, **options) -> DataFrame:
    return stage_one.realised_trades(
        fx.events, fx.pools, fx.logs, fx.transactions, fx.stored_prices, StageOneOptions(**options), walk_rows=walk_rows
    ).withColumns({
        **{c: F.round(c, 3) for c in ("bought_amount", "sold_amount", "closed_amount")},
        "realised_profit_usd": F.round("realised_profit_usd", 2),
    })


@query
def realised_profit(fx: Fixture) -> DataFrame:
    """What wallets made of their buys by selling within 90 days, at average cost."""
    return _realised(fx)


@query
def realised_profit_sliced(fx: Fixture) -> DataFrame:
    """The same where every wallet with more than three trades of a token lies in slices."""
    return _realised(fx, walk_rows=3)


@query
def realised_profit_hours(fx: Fixture) -> DataFrame:
    """The same for buys of the hours 12 to 84 after the start of the crisis day."""
    return _realised(fx, hours=(12, 84))
