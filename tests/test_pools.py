from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import EVENTS, LOGS, POOLS, address, day, event, pair_created, rows
from slumptrace.constants import BASE_TOKENS, PAIR_CREATED_TOPIC, PAIR_FACTORY
from slumptrace.operators import pools, scale
from slumptrace.sources import readers

WETH, DAI = "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2", "0x6b175474e89094c44da98b954eedeac495271d0f"


def test_either_side_and_several_crises(frame):
    events = frame(EVENTS, event("c1", "A", "2022-01-01", "2022-01-05"), event("c2", "A", "2022-01-03", "2022-01-09"),
                   event("c3", "B", "2022-01-01", "2022-01-02"))
    found = pools.crisis_pools(
        readers.pools(frame(POOLS, ("p1", "a", "x", "P"), ("p2", "x", "A", "P"), ("P3", "a", "b", "P"), ("p4", "x", "y", "P"),
                            ("p5", "a", "a", "P"), ("p1", "a", "x", "P"), ("p6", None, "b", "P"))),
        readers.crisis_events(events))
    assert rows(found, "pool_address", "crisis_id") == [
        ("p1", "c1"), ("p1", "c2"), ("p2", "c1"), ("p2", "c2"), ("p3", "c1"), ("p3", "c2"), ("p3", "c3"),
        ("p5", "c1"), ("p5", "c2"), ("p6", "c3")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=40),
       st.lists(st.integers(0, 9), min_size=1, max_size=10))
def test_equals_the_either_or_join(spark, pairs, tokens):
    pool_df = spark.createDataFrame([(f"p{i}", str(a), str(b), "P") for i, (a, b) in enumerate(pairs)], POOLS)
    event_df = readers.crisis_events(spark.createDataFrame(
        [event(f"c{i}", str(t), "2022-01-01", "2022-01-02") for i, t in enumerate(tokens)], EVENTS))
    expected = sorted({(f"p{i}", f"c{j}") for i, pair in enumerate(pairs)
                       for j, t in enumerate(tokens) if t in pair})
    assert rows(pools.crisis_pools(pool_df, event_df), "pool_address", "crisis_id") == expected


def test_build_pools(frame):
    crisis1, crisis2, other = 0x10, 0x20, 0x99
    events = frame(EVENTS, event("c1", address(crisis2), "2022-01-01", "2022-01-05"),
                   event("c2", address(crisis1).upper().replace("X", "x"), "2022-01-01", "2022-01-05"))
    short = pair_created(crisis1, 1, 0xA5)
    logs = frame(
        LOGS,
        pair_created(crisis1, int(WETH, 16), 0xA1), pair_created(int(DAI, 16), crisis2, 0xA2),
        pair_created(crisis1, crisis2, 0xA3), pair_created(crisis1, other, 0xA4),
        pair_created(int(WETH, 16), int(DAI, 16), 0xA6),
        pair_created(crisis1, int(WETH, 16), 0xA7, factory=address(7)),
        pair_created(crisis1, int(WETH, 16), 0xA8, when="2019-12-31"),
        # Too few topics, and another kind of event.
        (*short[:4], [PAIR_CREATED_TOPIC, short[4][1]], short[5]), (*short[:4], ["0x1", *short[4][1:]], short[5]),
    )
    assert rows(pools.build_pools(logs, events, since="2020-01-01")) == [
        (address(0xA1), "CRISIS1-WETH Pool", address(crisis1), "CRISIS1", WETH, "WETH", "Uniswap V2", "ethereum"),
        (address(0xA2), "DAI-CRISIS2 Pool", DAI, "DAI", address(crisis2), "CRISIS2", "Uniswap V2", "ethereum")]
    # Without a bound older pools are there as well.
    assert {r.pool_address for r in pools.build_pools(logs, events).collect()} == {address(p) for p in (0xA1, 0xA2, 0xA8)}


def test_base_name_wins_and_unknown_is_unk(frame):
    events = frame(EVENTS, event("c1", WETH, "2022-01-01", "2022-01-05"), event("c2", "0xa", "2022-01-01", "2022-01-05"))
    roles = pools.token_roles(events, pools.base_tokens(events))
    assert len(BASE_TOKENS) + 1 == roles.count()
    named = pools.with_symbols(frame(POOLS, ("p", WETH, "0xa", "P"), ("q", "0xb", DAI, "P")), roles)
    assert rows(named, "pool_address", "token0_symbol", "token1_symbol") == [
        ("p", "WETH", "CRISIS1"), ("q", "UNK", "DAI")]


def test_stored_logs_are_lower_case_and_pruned(spark, frame, tmp_path):
    """Raw logs in any case are stored once; scans of the stored ones skip by day, topic and address."""
    from slumptrace.plans.jobs import store_logs

    row = pair_created(1, 2, 3, factory=PAIR_FACTORY.upper().replace("X", "x"))
    store_logs(frame(LOGS, row, pair_created(1, 2, 4, when="2021-03-01")), str(tmp_path / "logs"))
    stored = spark.read.parquet(str(tmp_path / "logs"))
    found = readers.factory_logs(stored)
    assert found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(address" in plan or "In(address" in plan
    swaps = readers.swap_logs(stored, days=[day("2021-01-01")], topics=(PAIR_CREATED_TOPIC,))
    plan = swaps._jdf.queryExecution().executedPlan().toString()
    assert swaps.count() == 1
    assert "PartitionFilters: [isnotnull(block_date" in plan.replace("\n", " ") or "block_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_large_sides_give_the_same_result(frame, monkeypatch):
    events = frame(EVENTS, event("c1", "a", "2022-01-01", "2022-01-05"), event("c2", "b", "2022-01-01", "2022-01-05"))
    pool_df = frame(POOLS, *[(f"p{i}", "a" if i % 3 else "b", "xyb"[i % 3], "P") for i in range(50)])
    small = rows(pools.crisis_pools(pool_df, readers.crisis_events(events)))
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)
    assert rows(pools.crisis_pools(pool_df, readers.crisis_events(events))) == small
