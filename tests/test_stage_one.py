import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import (
    EVENTS, LOGS, POOLS, PRICES, TRANSACTIONS, UNIT, at, day, event, payload, rows, swap,
)
from slumptrace.constants import ZERO_ADDRESS
from slumptrace.functions.logs import PROTOCOLS, Protocol
from slumptrace.operators import pools as pool_ops
from slumptrace.operators import scale, swaps
from slumptrace.plans.stage_one import StageOneOptions, format_buys, newest_first, stage_buys, unpriced_buys
from slumptrace.schemas import STAGED_BUYS
from slumptrace.sources import readers

BUY0, BUY1 = payload(0, 5 * UNIT, 2 * UNIT, 0), payload(5 * UNIT, 0, 0, 3 * UNIT)


@pytest.fixture
def world(frame):
    """Two overlapping crises of token a, one of token b, and a pool of both."""
    return {
        "events": frame(EVENTS, event("c1", "A", "2022-01-10", "2022-01-12"), event("c2", "a", "2022-01-12", "2022-01-14"),
                        event("c3", "b", "2022-01-12", "2022-01-12")),
        "pools": frame(POOLS, ("P1", "a", "x", "Uniswap V2"), ("p2", "x", "a", "Uniswap V2"),
                       ("p3", "a", "b", "Uniswap V2"), ("p4", "a", "x", "SushiSwap"), ("p5", "x", "y", "Uniswap V2")),
        "transactions": frame(TRANSACTIONS, ("t1", "0xW1"), ("t2", "w2"), ("t3", None), ("t4", ""), ("t5", ZERO_ADDRESS)),
        "history": frame(PRICES, ("a", 10.0, day("2022-01-10")), ("a", 12.0, day("2022-01-12"))),
    }


def staged(world, logs, **options):
    return stage_buys(world["events"], world["pools"], logs, world["transactions"], world["history"],
                      StageOneOptions(**options))


def test_window_ends_are_inclusive(frame, world):
    logs = frame(LOGS, *[swap(t, "t1", "p2", BUY1) for t in (
        "2022-01-09 23:59:59", "2022-01-10 00:00:00", "2022-01-14 23:59:59", "2022-01-15 00:00:00")])
    assert rows(staged(world, logs), "crisis_id", "first_buy_timestamp") == [
        ("c1", at("2022-01-10 00:00:00")), ("c2", at("2022-01-14 23:59:59"))]


def test_overlapping_windows_and_double_pools_fan_out(frame, world):
    logs = frame(LOGS, swap("2022-01-12 08:00:00", "t1", "p1", BUY0),
                 swap("2022-01-12 09:00:00", "t2", "p3", payload(0, 0, 2 * UNIT, 3 * UNIT)))
    assert rows(staged(world, logs), "crisis_id", "wallet_address", "token_address", "total_amount_bought") == [
        ("c1", "0xw1", "a", 2.0), ("c1", "w2", "a", 2.0), ("c2", "0xw1", "a", 2.0), ("c2", "w2", "a", 2.0),
        ("c3", "w2", "b", 3.0)]


def test_unusable_swaps_are_dropped(frame, world):
    when = "2022-01-11 08:00:00"
    logs = frame(
        LOGS,
        *[swap(when, t, "p1", BUY0) for t in ("t3", "t4", "t5", "unknown", None)],
        swap(when, "t1", "p4", BUY0), swap(when, "t1", "p5", BUY0), swap(when, "t1", "p1", None),
        swap(when, "t1", "p1", "0x"), swap(when, "t1", "p1", "0x" + "zz" * 128), swap(when, "t1", "p1", payload(5, 0, 0, 5)),
        swap(when, "t1", "p1", BUY0, topic0="0xother"),
    )
    no_topics = (*swap(when, "t1", "p1", BUY0)[:4], [], BUY0)
    result = staged(world, logs.union(frame(LOGS, no_topics)))
    assert result.count() == 0
    assert result.schema.simpleString() == STAGED_BUYS.schema.simpleString()


def test_prices_and_spend(frame, world):
    # Clipped to the days of the buys, the history of token a begins after its buy. Token b has none.
    logs = frame(LOGS, swap("2022-01-11 08:00:00", "t1", "p1", BUY0), swap("2022-01-12 08:00:00", "t1", "p3", payload(0, 0, 0, UNIT)))
    assert rows(staged(world, logs), "crisis_id", "first_buy_price", "total_usd_spent", "num_transactions") == [
        ("c1", 12.0, 24.0, 1), ("c3", 1.0, 1.0, 1)]
    assert rows(staged(world, logs, clip_history=False), "crisis_id", "first_buy_price", "total_usd_spent") == [
        ("c1", 10.0, 20.0), ("c3", 1.0, 1.0)]


def test_shifted_words(frame, world):
    logs = frame(LOGS, swap("2022-01-11 08:00:00", "t1", "p1", payload(1 * UNIT, 2 * UNIT, 3 * UNIT, 4 * UNIT)),
                 swap("2022-01-11 09:00:00", "t1", "p2", payload(1 * UNIT, 2 * UNIT, 3 * UNIT, 4 * UNIT)))
    assert rows(staged(world, logs, decode="shifted"), "total_amount_bought") == [(2.0,), (3.0,)]
    assert rows(staged(world, logs), "total_amount_bought") == [(3.0,), (4.0,)]


def test_configured_range_narrows_the_scan(frame, world):
    logs = frame(LOGS, swap("2022-01-10 08:00:00", "t1", "p1", BUY0), swap("2022-01-11 00:00:00", "t1", "p1", BUY0),
                 swap("2022-01-11 00:00:01", "t1", "p1", BUY0))
    got = staged(world, logs, start="2022-01-10 12:00:00", end="2022-01-11")
    assert rows(got, "first_buy_timestamp") == [(at("2022-01-11 00:00:00"),)]


def test_latest_swaps_limit(frame, world):
    logs = frame(LOGS, *[swap(f"2022-01-1{d} 0{h}:00:00", "t1", "p1", BUY0, h) for d in (0, 1) for h in range(5)])
    assert rows(staged(world, logs, latest=7), "first_buy_timestamp") == [
        (at(f"2022-01-1{d} 0{h}:00:00"),) for d, h in [(0, 3), (0, 4)] + [(1, h) for h in range(5)]]


@pytest.mark.parametrize("task_rows", [scale.TASK_ROWS, 3])
def test_latest_equals_a_full_sort(spark, monkeypatch, task_rows):
    monkeypatch.setattr(scale, "TASK_ROWS", task_rows)
    rng = random.Random(5)
    made = [(datetime(2022, 1, 1) + timedelta(hours=rng.randrange(60)), f"t{rng.randrange(40)}", rng.randrange(3),
             f"p{rng.randrange(3)}", "d") for _ in range(200)]
    df = spark.createDataFrame(
        made, "block_timestamp timestamp, transaction_hash string, log_index bigint, pool_address string, data string")
    ordered = sorted(made, key=lambda r: (-r[0].timestamp(), *r[1:]))
    for n in (0, 1, 37, 120, 200, 500):
        assert rows(swaps.latest(df, n)) == sorted(ordered[:n], key=repr)


def test_few_and_many_buys_find_the_same_senders(frame, world, monkeypatch):
    logs = frame(LOGS, *[swap(f"2022-01-11 0{h}:00:00", f"t{h % 3 + 1}", "p1", BUY0) for h in range(9)])
    few = rows(unpriced_buys(world["events"], world["pools"], logs, world["transactions"]))
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)
    assert rows(unpriced_buys(world["events"], world["pools"], logs, world["transactions"])) == few
    assert len(few) == 6


def test_formatting(frame):
    priced = frame(
        "crisis_id string, wallet_address string, token_address string, first_buy_timestamp timestamp, "
        "first_buy_price string, total_amount_bought double, total_usd_spent double",
        ("c1", "w", "t", at("2022-01-01 01:00:00"), "1.5", 2.0, float("nan")), ("c1", "nan", "t", at("2022-01-01"), "1", 1.0, 1.0),
        ("", "w", "t", at("2022-01-01"), "1", 1.0, 1.0), ("c1", "w", None, at("2022-01-01"), "1", 1.0, 1.0),
        ("c1", "w", "t", None, "1", 1.0, 1.0), ("c0", "w", "t", at("2022-01-01 00:00:00"), "oops", 1.0, 1.0),
        ("c1", "w", "t", at("2022-01-01 02:00:00"), "3", 1.0, 1.0))
    got = [tuple(r) for r in newest_first(format_buys(priced)).collect()]
    assert got == [
        ("c0", "w", "t", at("2022-01-01 00:00:00"), None, 1.0, 1.0, 1),
        ("c1", "w", "t", at("2022-01-01 02:00:00"), 3.0, 1.0, 1.0, 1),
        ("c1", "w", "t", at("2022-01-01 01:00:00"), 1.5, 2.0, None, 1)]


def test_swap_scan_with_pool_keys_and_stored_topic(frame):
    logs = frame(LOGS, swap("2022-01-01", "t1", "p1", BUY0), swap("2022-01-01", "t1", "p2", BUY0))
    keys = frame("pool_address string", ("p1",), ("p1",))
    assert readers.swap_logs(logs, pool_keys=keys).count() == 1
    stored = logs.withColumn("topic0", F.get("topics", F.lit(0))).drop("topics")
    assert readers.swap_logs(stored, pool_keys=keys).count() == 1


def test_bounds_are_times_not_text(frame, world):
    logs = frame(LOGS, swap("2022-01-10 08:00:00", "t1", "p1", BUY0), swap("2022-01-11 08:00:00", "t1", "p1", BUY0))
    assert rows(staged(world, logs, start="2021-9-1", end="2022-1-11"), "first_buy_timestamp") == [(at("2022-01-10 08:00:00"),)]
    with pytest.raises(ValueError, match="no date"):
        staged(world, logs, end="last week")


def test_no_bounds_by_default(frame):
    logs = frame(LOGS, swap("2015-08-01", "t1", "p1", BUY0), swap("2030-01-01", "t1", "p1", BUY0))
    assert readers.swap_logs(logs).count() == 2


def test_many_crises_of_a_token_do_not_multiply_swaps(frame, world):
    """A swap meets the crises of its day only: the join makes no row that the date test would drop."""
    events = frame(EVENTS, *[event(f"c{i}", "a", str(day("2019-01-01") + timedelta(days=i)), str(day("2019-01-01") + timedelta(days=i)))
                             for i in range(1_000)])
    logs = frame(LOGS, *[swap("2020-01-01 08:00:00", "t1", "p1", BUY0, i) for i in range(20)])
    crossed = pool_ops.crisis_pools(readers.pools(world["pools"]), readers.crisis_events(events))
    found = swaps.in_windows(readers.swap_logs(logs), crossed)
    assert found.count() == 20
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    on = plan.split("Join Inner")[1].split("\n")[0]
    assert "level" in on and "piece" in on and "<" not in on


@pytest.mark.parametrize("seed", range(3))
def test_windows_in_pieces_equal_windows_by_day(frame, seed):
    """Every day of a window lies in exactly one of its pieces, and no other day does."""
    rng = random.Random(seed)
    windows = []
    for k in range(60):
        start = date(1969, 11, 1) + timedelta(days=rng.randrange(120))
        windows.append((f"p{k}", start, start + timedelta(days=rng.choice([0, 1, 2, 6, 31, 94, 364, rng.randrange(400), -1]))))
    df = frame("pool_address string, window_start_date date, window_end_date date", *windows)
    held = {}
    for r in swaps.window_pieces(df).collect():
        held.setdefault(r.pool_address, []).append(range(r.piece << r.level, (r.piece + 1) << r.level))
    for pool, start, end in windows:
        days = range((start - date(1970, 1, 1)).days, (end - date(1970, 1, 1)).days + 1)
        assert sorted(d for piece in held.get(pool, []) for d in piece) == list(days)
        assert len(held.get(pool, [])) <= (0 if not days else 2 * math.floor(math.log2(len(days))) + 1)
    assert max(map(len, held.values())) <= 18


def test_swaps_meet_the_windows_of_their_day(frame):
    rng = random.Random(6)
    first = date(2020, 1, 1)
    windows = [(f"p{rng.randrange(4)}", f"c{k}", s, s + timedelta(days=rng.randrange(-1, 200)))
               for k in range(40) for s in [first + timedelta(days=rng.randrange(300))]]
    made = [(at(f"{first + timedelta(days=rng.randrange(-5, 520))} {rng.randrange(24):02}:30:00"), f"p{rng.randrange(6)}", k) for k in range(400)]
    crossed = frame("pool_address string, crisis_id string, window_start_date date, window_end_date date", *windows)
    found = swaps.in_windows(frame("block_timestamp timestamp, pool_address string, n long", *made), crossed)
    expected = sorted((n, c) for t, p, n in made for q, c, s, e in windows if p == q and s <= t.date() <= e)
    assert rows(found, "n", "crisis_id") == sorted(expected, key=repr) and len(expected) > 100


def test_stored_transactions_stay_where_they_are(spark, frame, world, monkeypatch):
    """Swaps beyond the broadcast limit move to the buckets of the transactions, not the other way round."""
    from slumptrace.plans import jobs

    logs = frame(LOGS, *[swap(f"2022-01-11 0{h}:00:00", f"t{h % 3 + 1}", "p1", BUY0) for h in range(9)])
    plain = rows(unpriced_buys(world["events"], world["pools"], logs, world["transactions"]))
    spark.sql("CREATE DATABASE bucketed")
    try:
        world["transactions"].write.saveAsTable("bucketed.raw")
        assert jobs.store_transactions(spark, "bucketed", "bucketed.raw", buckets=5) == 5
        assert jobs.store_transactions(spark, "bucketed", "bucketed.raw") == 1
        jobs.store_transactions(spark, "bucketed", "bucketed.raw", buckets=5)
        monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = unpriced_buys(world["events"], world["pools"], logs, spark.table("bucketed.stored_transactions"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == plain
        # The side of the transactions has no exchange between scan and join.
        lines = plan.split("\n")
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "from_address" in line)
        join = max(i for i, line in enumerate(lines) if "SortMergeJoin" in line and i < scan)
        depth = lines[scan].index("FileScan")
        above = [line for line in lines[join + 1:scan] if len(line) - len(line.lstrip(" :+-")) < depth and not line.lstrip().startswith(":")]
        assert "Bucketed: true" in lines[scan] and not any("Exchange" in line for line in above), plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_senders_by_day_and_hash(spark, frame, world, tmp_path):
    logs = frame(LOGS, *[swap(f"2022-01-11 0{h}:00:00", f"t{h % 2 + 1}", "p1", BUY0) for h in range(9)])
    plain = rows(unpriced_buys(world["events"], world["pools"], logs, world["transactions"]))
    dated = world["transactions"].withColumn("block_date", F.lit("2022-01-11").cast("date"))
    dated = dated.union(frame(TRANSACTIONS, ("t1", "elsewhere")).withColumn("block_date", F.lit("2022-01-09").cast("date")))
    dated.write.partitionBy("block_date").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = unpriced_buys(world["events"], world["pools"], logs, stored)
    assert rows(found) == plain
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any("= 2022-01-11)" in part.split("PushedFilters")[0] for part in plan.split("PartitionFilters: [")[1:])


def test_protocols_with_their_own_event_and_decimals(frame, world):
    other = Protocol("SushiSwap", "0xf", swap_topic="0xs", out0_word=0, out1_word=1, in0_word=2, in1_word=3)
    when = "2022-01-11 08:00:00"
    logs = frame(LOGS, swap(when, "t1", "p1", BUY0), swap(when, "t1", "p4", payload(7 * UNIT, 0, 0, 0), topic0="0xs"),
                 swap(when, "t2", "p4", BUY0), swap(when, "t2", "p1", BUY0, topic0="0xs"))
    both = {"protocols": (*PROTOCOLS, other)}
    assert rows(staged(world, logs, **both), "wallet_address", "total_amount_bought") == [("0xw1", 2.0), ("0xw1", 7.0)]
    world["pools"] = world["pools"].withColumn("token0_decimals", F.when(F.col("pool_address") == "p4", 17)).withColumn(
        "token1_decimals", F.lit(18))
    assert rows(staged(world, logs, **both), "wallet_address", "total_amount_bought") == [("0xw1", 2.0), ("0xw1", 70.0)]


def test_buys_by_the_hour_reach_beyond_the_windows(frame, world):
    logs = frame(LOGS, *[swap(t, "t1", "p2", BUY1) for t in ("2022-01-10 11:59:59", "2022-01-10 12:00:00", "2022-01-13 12:00:00", "2022-01-13 12:00:01")])
    world["events"] = world["events"].where("crisis_id = 'c1'")
    assert rows(staged(world, logs, hours=(12, 84)), "first_buy_timestamp") == [(at("2022-01-10 12:00:00"),), (at("2022-01-13 12:00:00"),)]


def test_zone_less_times(frame, world):
    logs = frame(LOGS, swap("2022-01-11 08:00:00", "t1", "p1", BUY0)).withColumn(
        "block_timestamp", F.col("block_timestamp").cast("timestamp_ntz"))
    assert rows(staged(world, logs), "first_buy_timestamp") == [(at("2022-01-11 08:00:00"),)]


def test_senders_use_their_own_block_time(frame):
    df = frame("hash string, from_address string, block_timestamp timestamp", ("t1", "W", at("2022-01-01")),
               ("t2", "w", at("2023-01-01")))
    assert rows(readers.senders(df, "2021-12-31", "2022-06-01")) == [("t1", "w")]
