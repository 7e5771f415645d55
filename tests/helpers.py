"""Hand-made rows for the tests."""

from __future__ import annotations

from datetime import date, datetime

from slumptrace.constants import PAIR_CREATED_TOPIC, PAIR_FACTORY, SWAP_TOPIC

EVENTS = (
    "crisis_id string, token_address string, crisis_date date, crisis_name string, "
    "window_start_date date, window_end_date date, dt date"
)
POOLS = "pool_address string, token0_address string, token1_address string, dex_protocol string"
LOGS = (
    "block_timestamp timestamp, transaction_hash string, log_index bigint, address string, "
    "topics array<string>, data string"
)
TRANSACTIONS = "hash string, from_address string"
PRICES = "token_address string, price_usd double, dt date"
BUYS = (
    "crisis_id string, wallet_address string, token_address string, first_buy_timestamp timestamp, "
    "first_buy_price double, total_amount_bought double, total_usd_spent double, num_transactions bigint"
)
UNIT = 10**18


def day(text: str) -> date:
    return date.fromisoformat(text)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def address(n: int) -> str:
    return f"0x{n:040x}"


def topic(n: int) -> str:
    return f"0x{n:064x}"


def payload(*words: int) -> str:
    return "0x" + "".join(f"{w:064x}" for w in words)


def event(crisis_id: str, token: str, start: str, end: str) -> tuple:
    return crisis_id, token, day(start), f"{crisis_id} name", day(start), day(end), day(start)


def swap(when: str, tx: str, pool: str, data: str | None, index: int = 0, topic0: str = SWAP_TOPIC) -> tuple:
    return at(when), tx, index, pool, [topic0], data


def pair_created(token0: int, token1: int, pool: int, factory: str = PAIR_FACTORY, when: str = "2021-01-01") -> tuple:
    return at(when), "0x0", 0, factory, [PAIR_CREATED_TOPIC, topic(token0), topic(token1)], payload(pool, 1)


def buy(wallet: str, when: str, price: float | None, amount: float, token: str = "T", crisis: str = "c1") -> tuple:
    spent = None if price is None else price * amount
    return crisis, wallet, token, at(when), price, amount, spent, 1


def rows(df, *columns: str) -> list[tuple]:
    """The rows as sorted tuples, for comparison."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
