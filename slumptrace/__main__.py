"""Run one step of the analysis: python -m slumptrace STEP --help shows its options."""

from __future__ import annotations

import argparse
import re
import sys

from pyspark.sql import DataFrame

from slumptrace.constants import DEFAULT_PRICE, MIN_PROFIT_PCT, RECOVERY_DAYS, TOKEN_DECIMALS, TOP_WALLETS
from slumptrace.functions.logs import PROTOCOLS, Protocol
from slumptrace.plans import jobs
from slumptrace.plans.stage_one import StageOneOptions
from slumptrace.plans.stage_two import StageTwoOptions
from slumptrace.session import build_session


def protocol(text: str) -> Protocol:
    """A protocol from ``NAME=FACTORY``, with the events and payload of the first known one."""
    name, _, factory = text.partition("=")
    if not name or not re.fullmatch("0x[0-9a-fA-F]{40}", factory):
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=FACTORY")
    return Protocol(name, factory.lower())


def stage_one_options(args: argparse.Namespace) -> StageOneOptions:
    return StageOneOptions(
        args.start, args.end, getattr(args, "latest", None), args.decode, args.decimals, (*PROTOCOLS, *(args.protocol or ())),
        clip_history=not getattr(args, "full_history", False), default_price=args.default_price,
        hours=tuple(args.hours) if args.hours else None)


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="slumptrace")
    steps = parser.add_subparsers(dest="step", required=True)
    for name in ("crises", "pools", "verify", "stage-one", "stage-two", "labels", "realised"):
        step = steps.add_parser(name)
        step.add_argument("--database", required=True)
        if name != "verify":
            step.add_argument("--dry-run", action="store_true", help="compute and check, but write no table")
        if name in ("pools", "verify"):
            step.add_argument("--since", help="look at logs from this day on only")
        if name == "crises":
            step.add_argument("--window-days", type=int, default=30)
            step.add_argument("--max-return-pct", type=float, default=-20.0, help="fall against the days before that counts")
            step.add_argument("--max-excess-pct", type=float, default=-15.0, help="fall beyond the market's that counts")
            step.add_argument("--max-drain-pct", type=float, default=-50.0, help="loss of liquidity that counts")
        if name in ("pools", "verify", "stage-one", "realised"):
            step.add_argument("--logs", required=True, help="table or Parquet folder of event logs")
        if name == "pools":
            step.add_argument("--drop", action="store_true", help="create the pool table anew")
        if name in ("stage-one", "realised"):
            step.add_argument("--transactions", required=True, help="table or Parquet folder of transactions")
            step.add_argument("--start")
            step.add_argument("--end")
            step.add_argument("--decode", choices=("abi", "shifted"), default="abi")
            step.add_argument("--decimals", type=int, default=TOKEN_DECIMALS, help="of tokens whose pool carries none")
            step.add_argument("--default-price", type=float, default=DEFAULT_PRICE, help="of tokens without any quote")
            step.add_argument("--hours", type=int, nargs=2, metavar=("FROM", "TO"), help="only buys that many hours after the crisis day began")
            step.add_argument("--protocol", action="append", type=protocol, metavar="NAME=FACTORY", help="another exchange with the same events; may be repeated")
        if name == "stage-one":
            step.add_argument("--latest", type=int, help="keep only that many of the newest swaps")
            step.add_argument("--full-history", action="store_true", help="see prices outside the days of the buys")
        if name in ("stage-two", "realised"):
            step.add_argument("--recovery-days", type=int, default=RECOVERY_DAYS)
        if name == "stage-two":
            step.add_argument("--min-profit-pct", type=float, default=MIN_PROFIT_PCT)
            step.add_argument("--top", type=int, default=TOP_WALLETS)
    for name, source in (("logs", "event logs"), ("transactions", "transactions")):
        step = steps.add_parser(f"store-{name}")
        step.add_argument("--source", required=True, help=f"table or Parquet folder of raw {source}")
        step.add_argument("--store" if name == "logs" else "--database", required=True)
    return parser.parse_args(argv)


def first_rows(df: DataFrame) -> None:
    df.show(10, truncate=False)


def main(argv: list[str]) -> int:
    args = arguments(argv)
    spark = build_session()
    if args.step == "crises":
        found = jobs.find_crises(
            spark, args.database, args.window_days, args.max_return_pct, args.max_excess_pct, args.max_drain_pct, args.dry_run)
        print(found, "crises")
    elif args.step == "store-logs":
        print(jobs.append_logs(spark, args.source, args.store), "new logs")
    elif args.step == "store-transactions":
        print(jobs.store_transactions(spark, args.database, args.source), "buckets")
    elif args.step == "realised":
        found = jobs.realise(
            spark, args.database, args.logs, args.transactions, stage_one_options(args), args.recovery_days, args.dry_run)
        print(found, "wallets and tokens")
    elif args.step == "pools":
        print(jobs.prepare_pools(spark, args.database, args.logs, dry_run=args.dry_run, drop=args.drop, since=args.since), "pools")
    elif args.step == "verify":
        report = jobs.verify(spark, args.database, args.logs, args.since)
        for part in (report.completeness, report.moves, report.coverage):
            part.show(truncate=False)
        return 0 if report.passed else 1
    elif args.step == "stage-one":
        found = jobs.stage_one(
            spark, args.database, args.logs, args.transactions, stage_one_options(args), args.dry_run, sample=first_rows
        )
        print(found, "buys")
    elif args.step == "stage-two":
        options = StageTwoOptions(args.recovery_days, args.min_profit_pct, args.top)
        outcome = jobs.stage_two(spark, args.database, options, args.dry_run)
        outcome.board.orderBy("rank").show(args.top, truncate=False)
        outcome.board_trades.orderBy("rank", "trade_no").show(truncate=False)
    else:
        print(jobs.label_wallets(spark, args.database, args.dry_run), "wallets")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
