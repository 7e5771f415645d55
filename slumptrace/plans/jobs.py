"""The runs a user starts: store logs, find crises, prepare the tables, stage the buys, rank and label the wallets.

Each reads and writes tables of one database; raw logs and transactions may be tables or Parquet folders.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from slumptrace import schemas
from slumptrace.constants import BASE_TOKENS, RECOVERY_DAYS
from slumptrace.functions.logs import PROTOCOLS, Protocol
from slumptrace.operators import crisis, labels, profit, quality
from slumptrace.operators.pools import base_tokens, build_pools
from slumptrace.operators.scale import materialize, staged_run
from slumptrace.plans.stage_one import StageOneOptions, realised_trades, stage_buys
from slumptrace.plans.stage_two import Outcome, StageTwoOptions, board_of, profitable_trades, rank_wallets
from slumptrace.sources import catalog, logstore, readers
from slumptrace.sources.sinks import write_table

Sample = Callable[[DataFrame], None]
# Transactions of one stored bucket.
BUCKET_ROWS = 2_000_000


def _table(spark: SparkSession, database: str, table: schemas.Table) -> DataFrame:
    return readers.load_table(spark, database, table)


@dataclass(frozen=True)
class QualityReport:
    """Verdict of the checks, and the frames behind it."""

    passed: bool
    completeness: DataFrame
    moves: DataFrame
    coverage: DataFrame


def prepare_pools(
    spark: SparkSession,
    database: str,
    logs: str,
    base: Mapping[str, str] = BASE_TOKENS,
    protocols: Sequence[Protocol] = PROTOCOLS,
    dry_run: bool = False,
    drop: bool = False,
    since: str | None = None,
) -> int:
    """Create the tables and fill the pool dimension from pair-created logs, from ``since`` on if given."""
    catalog.ensure_tables(spark, database, [schemas.POOLS] if drop else schemas.TABLES.values(), drop)
    events = readers.require_rows(_table(spark, database, schemas.CRISIS_EVENTS), "crisis events")
    with staged_run(spark):
        found = build_pools(readers.load(spark, logs), events, base_tokens(events, base), protocols, since)
        return write_table(found, database, schemas.POOLS, dry_run=dry_run, on_empty="error")


def verify(spark: SparkSession, database: str, logs: str, since: str | None = None) -> QualityReport:
    """Check that the input tables are filled, that prices fell in the crises, and that pools are in use.

    Use is looked for in all logs, or from ``since`` on.
    """
    inputs = {}
    for table in (schemas.CRISIS_EVENTS, schemas.POOLS, schemas.PRICES):
        try:
            inputs[table.name] = _table(spark, database, table)
        except AnalysisException:
            inputs[table.name] = catalog.empty(spark, table)
    events, pools, history = inputs.values()
    completeness = quality.check_completeness(inputs)
    moves = quality.check_crisis_moves(events, history)
    activity = quality.pool_activity(readers.load(spark, logs), pools, since)
    found = quality.pool_coverage(pools, activity)
    # One row.
    coverage = spark.createDataFrame(found.collect(), found.schema)
    passed = (
        completeness.where("NOT passed").isEmpty()
        and quality.crisis_moves_summary(moves).first()["passed"]
        and coverage.first()["passed"]
    )
    return QualityReport(bool(passed), completeness, moves, coverage)


def stage_one(
    spark: SparkSession,
    database: str,
    logs: str,
    transactions: str,
    options: StageOneOptions = StageOneOptions(),
    dry_run: bool = False,
    sample: Sample | None = None,
) -> int:
    """Find, price and store the buys. Missing crises or pools fail; no buys only warns."""
    with staged_run(spark):
        staged = stage_buys(
            readers.require_rows(_table(spark, database, schemas.CRISIS_EVENTS), "crisis events"),
            readers.require_rows(_table(spark, database, schemas.POOLS), "pools"),
            readers.load(spark, logs),
            readers.load(spark, transactions),
            _table(spark, database, schemas.PRICES),
            options,
        )
        return write_table(
            staged, database, schemas.STAGED_BUYS, dry_run=dry_run, validate=quality.require_valid, sample=sample
        )


def stage_two(
    spark: SparkSession,
    database: str,
    options: StageTwoOptions = StageTwoOptions(),
    dry_run: bool = False,
    sample: Sample | None = None,
) -> Outcome:
    """Estimate, rank and store the profitable trades. Missing buys or prices fail.

    The outcome reads the stored trades. After a dry run, or without any trade, nothing is stored, and it reads
    intermediate tables that last as long as the session.
    """
    staged = readers.require_rows(_table(spark, database, schemas.STAGED_BUYS), "crisis buyers")
    history = readers.require_rows(_table(spark, database, schemas.PRICES), "price history")
    if dry_run:
        outcome = rank_wallets(readers.staged_buys(staged), history, options)
        write_table(outcome.trades, database, schemas.PROFITABLE_TRADES, dry_run=True, sample=sample)
        return outcome
    with staged_run(spark):
        trades = profitable_trades(readers.staged_buys(staged), history, options)
        rows = write_table(trades, database, schemas.PROFITABLE_TRADES, sample=sample)
    if rows == 0:
        return board_of(catalog.empty(spark, schemas.PROFITABLE_TRADES), options)
    return board_of(_table(spark, database, schemas.PROFITABLE_TRADES), options)


def label_wallets(spark: SparkSession, database: str, dry_run: bool = False) -> int:
    """Fill the label table from the stored buys and the price history."""
    with staged_run(spark):
        staged = readers.staged_buys(_table(spark, database, schemas.STAGED_BUYS))
        estimates = materialize(profit.estimate_pnl(staged, _table(spark, database, schemas.PRICES)), "estimates")
        return write_table(labels.wallet_labels(staged, estimates), database, schemas.WALLET_LABELS, dry_run=dry_run)


def find_crises(
    spark: SparkSession,
    database: str,
    window_days: int = 30,
    max_return_pct: float = -20.0,
    max_excess_pct: float = -15.0,
    max_drain_pct: float | None = -50.0,
    dry_run: bool = False,
) -> int:
    """Fill the crisis table from the price history: sharp falls and drained liquidity, with their buy windows."""
    catalog.ensure_tables(spark, database, [schemas.CRISIS_EVENTS])
    with staged_run(spark):
        history = readers.require_rows(_table(spark, database, schemas.PRICES), "price history")
        found = crisis.detect_crises(history, max_return_pct, max_excess_pct, max_drain_pct=max_drain_pct)
        events = crisis.detected_events(materialize(found, "crises"), window_days)
        return write_table(events, database, schemas.CRISIS_EVENTS, dry_run=dry_run)


def realise(
    spark: SparkSession,
    database: str,
    logs: str,
    transactions: str,
    options: StageOneOptions = StageOneOptions(),
    recovery_days: int = RECOVERY_DAYS,
    dry_run: bool = False,
) -> int:
    """Fill the table of realised profits per wallet and token; returns the rows. No profits only warns."""
    with staged_run(spark):
        found = realised_trades(
            readers.require_rows(_table(spark, database, schemas.CRISIS_EVENTS), "crisis events"),
            readers.require_rows(_table(spark, database, schemas.POOLS), "pools"),
            readers.load(spark, logs), readers.load(spark, transactions), _table(spark, database, schemas.PRICES),
            options, recovery_days)
        return write_table(found, database, schemas.REALISED_PROFIT, dry_run=dry_run)


def store_transactions(
    spark: SparkSession, database: str, transactions: str, name: str = "stored_transactions", buckets: int | None = None
) -> int:
    """Store transactions in buckets of their hash, each one file, and return the number of buckets.

    Joined to swaps by hash, a table stored so is read bucket by bucket and not shuffled; only swaps move. Without
    ``buckets`` one holds about two million transactions. The table is replaced as a whole; only hash, sender and time
    are kept.
    """
    source = readers.load(spark, transactions)
    kept = source.select("hash", "from_address", *[c for c in ("block_timestamp",) if c in source.columns])
    buckets = buckets or max(1, -(-kept.count() // BUCKET_ROWS))
    catalog.ensure_database(spark, database)
    kept.repartition(buckets, "hash").write.mode("overwrite").bucketBy(buckets, "hash").sortBy("hash").saveAsTable(f"{database}.{name}")
    return buckets


def store_logs(logs: DataFrame, target: str) -> None:
    """Lay raw logs out for the scans, once: lower-case addresses, ``topic0``, partitions by day sorted by address.

    Scans of such logs read the days they need, and skip row groups by topic and address. A busy day is written by
    several tasks. Replaces ``target`` as a whole; :func:`append_logs` adds to a store.
    """
    logstore.laid_out(logstore.normalised(logs)).write.partitionBy("block_date").mode("overwrite").parquet(target)


def append_logs(spark: SparkSession, source: str, store: str) -> int:
    """Add raw logs to a store by day (:func:`logstore.append_logs`); returns how many were new."""
    with staged_run(spark):
        return logstore.append_logs(readers.load(spark, source), store)
