import random

import pytest
from pyspark.sql import functions as F

from helpers import BUYS, EVENTS, LOGS, PRICES, at, buy, day, event, rows, swap
from slumptrace.operators import crisis, labels, quality, scale


def broken(report):
    return {(r["rule"], r["column"]): r["violations"] for r in report.collect() if r["violations"]}


def test_valid_buys_pass(frame):
    df = frame(BUYS, buy("w", "2022-01-01", 1.0, 2.0), buy("w", "2022-01-01", None, 0.0))
    assert broken(quality.validate_buys(df)) == {}
    quality.require_valid(df)


def test_every_rule_reports(frame):
    df = frame(BUYS, (None, "w", "t", at("2022-01-01"), -1.0, 1.0, 1.0, 1), ("c", None, None, None, 1.0, -1.0, -1.0, 2),
               ("c", "w", "t", at("2022-01-01"), 1.0, 1.0, 1.0, None))
    assert broken(quality.validate_buys(df)) == {
        ("not_null", "crisis_id"): 1, ("not_null", "wallet_address"): 1, ("not_null", "token_address"): 1,
        ("not_null", "first_buy_timestamp"): 1, ("not_negative", "first_buy_price"): 1,
        ("not_negative", "total_amount_bought"): 1, ("not_negative", "total_usd_spent"): 1,
        ("exactly_one", "num_transactions"): 2}
    with pytest.raises(ValueError, match="not_null\\(wallet_address\\): 1"):
        quality.require_valid(df)


def test_columns_and_types_are_checked(frame):
    df = frame("crisis_id string, wallet_address string, first_buy_timestamp string, first_buy_price string, "
               "total_amount_bought double, total_usd_spent double, num_transactions bigint",
               ("c", "w", "2022", "1", 1.0, 1.0, 1))
    assert broken(quality.validate_buys(df)) == {
        ("present", "token_address"): 1, ("type", "first_buy_timestamp"): 1, ("type", "first_buy_price"): 1}


def test_crisis_moves(frame):
    events = frame(EVENTS, *[event(f"c{i}", t, "2022-01-08", "2022-01-10") for i, t in enumerate("abcd")])

    def quotes(token, before, during, after):
        return [(token, before, day("2022-01-01")), (token, during, day("2022-01-08")), (token, after, day("2022-01-17"))]

    history = frame(PRICES, *quotes("a", 100.0, 95.0, 99.0), *quotes("b", 100.0, 96.0, 99.0), *quotes("c", None, 96.0, 99.0))
    checked = quality.check_crisis_moves(events, history)
    # A fall of exactly 5 % passes; crises without all three prices are left out.
    assert rows(checked, "crisis_id", "realistic") == [("c0", True), ("c1", False)]
    assert rows(quality.crisis_moves_summary(checked)) == [(2, 1, False)]
    assert rows(quality.crisis_moves_summary(checked.where("realistic"))) == [(1, 0, True)]
    assert rows(quality.crisis_moves_summary(checked.limit(0))) == [(0, 0, False)]
    assert quality.sample_rows(checked, 1, seed=1).count() == 1


def test_pool_activity_and_coverage(frame):
    logs = frame(LOGS, swap("2020-01-02", "t", "p1", "0x"), swap("2020-01-05", "t", "p1", "0x"), swap("2019-12-31", "t", "p2", "0x"),
                 swap("2020-01-05", "t", "stranger", "0x"))
    pools = frame("pool_address string", ("p1",), ("p2",), ("p3",))
    assert quality.pool_activity(logs, pools).count() == 2
    activity = quality.pool_activity(logs, pools, "2020-01-01")
    assert rows(activity) == [("p1", 2, at("2020-01-02"), at("2020-01-05"))]
    assert rows(quality.pools_with_activity(pools, activity), "pool_address", "transaction_count") == [
        ("p1", 2), ("p2", 0), ("p3", 0)]
    assert rows(quality.pool_coverage(pools, activity)) == [(3, 1, 2, 33.3, 66.7, True)]
    assert rows(quality.pool_coverage(pools, activity.limit(0))) == [(3, 0, 3, 0.0, 100.0, False)]
    assert rows(quality.pool_coverage(pools.limit(0), activity)) == [(0, 0, 0, None, None, False)]


def test_completeness_and_distinct_counts(frame):
    full = frame("a int, b int", (1, 1), (1, 2), (None, 2))
    assert rows(quality.check_completeness({"full": full, "empty": full.limit(0)})) == [
        ("empty", 0, False), ("full", 3, True)]
    assert rows(quality.distinct_counts(full, "a", "b")) == [(3, 1, 2)]


def test_buy_windows(frame):
    crises = frame("token_address string, crisis_date date, crisis_name string", ("b", day("2022-02-01"), "n2"),
                   ("a", day("2022-01-30"), "n1"))
    assert rows(crisis.buy_windows(crises, 3)) == [
        ("crisis_001", "a", day("2022-01-30"), "n1", day("2022-01-30"), day("2022-02-02"), day("2022-01-30")),
        ("crisis_002", "b", day("2022-02-01"), "n2", day("2022-02-01"), day("2022-02-04"), day("2022-02-01"))]
    ordered = crisis.first_crisis_order(crises)
    assert rows(ordered, "position", "token_address") == [(1, "a"), (2, "b")]


def test_phases(frame):
    events = frame(EVENTS, event("c1", "a", "2022-01-10", "2022-01-12"))
    days = frame("token_address string, dt date", *[("a", day(f"2022-01-{d:02}")) for d in range(1, 20)], ("b", day("2022-01-10")))
    got = {(r["token_address"], r["dt"].day): r["phase"] for r in crisis.crisis_phase(days, events).collect()}
    expected = {("a", d): "near" if 3 <= d < 7 else "drop" if 7 <= d <= 10 else "recovery" if 11 <= d <= 17 else "normal"
                for d in range(1, 20)}
    assert got == expected | {("b", 10): "normal"}


def test_latest_moving_crisis_decides_the_phase(frame):
    events = frame(EVENTS, event("c1", "a", "2022-01-10", "2022-01-12"), event("c2", "a", "2022-01-14", "2022-01-15"))
    days = frame("token_address string, dt date", *[("a", day(f"2022-01-{d:02}")) for d in (8, 10, 11, 14, 15)])
    # On the 10th the later crisis is merely near, so the earlier one still counts.
    got = {r["dt"].day: r["phase"] for r in crisis.crisis_phase(days, events).collect()}
    assert got == {8: "drop", 10: "drop", 11: "drop", 14: "drop", 15: "recovery"}


def test_detected_crises_are_sharp_and_specific(frame):
    def series(token, *values):
        return [(token, v, day(f"2022-01-{i + 1:02}")) for i, v in enumerate(values)]

    # Day 3: only a falls. Day 5: all fall.
    history = frame(PRICES, *series("a", 100.0, 100.0, 60.0, 55.0, 30.0), *series("b", 100.0, 100.0, 99.0, 99.0, 50.0),
                    *series("c", 100.0, 100.0, 98.0, 97.0, 50.0))
    assert rows(crisis.detect_crises(history), "token_address", "crisis_date") == [("a", day("2022-01-03"))]


def test_rollup_and_average_price(frame):
    df = frame(BUYS, buy("w", "2022-01-02", 3.0, 1.0), buy("w", "2022-01-01", 1.0, 3.0), buy("v", "2022-01-01", 1.0, 0.0))
    assert rows(labels.buyer_rollup(df), "wallet_address", "first_buy_timestamp", "first_buy_price", "total_amount_bought",
                "total_usd_spent", "num_transactions", "avg_buy_price") == [
        ("v", at("2022-01-01"), 1.0, 0.0, 0.0, 1, None), ("w", at("2022-01-01"), 1.0, 4.0, 6.0, 2, 1.5)]


def test_wallet_labels(frame):
    buys = frame(BUYS, *[buy("best", "2022-01-01", 1.0, 10.0, crisis=c) for c in ("c1", "c2")],
                 *[buy("once", "2022-01-01", 1.0, 10.0, crisis=c) for c in ("c1", "c1", "c3")], buy("none", "2022-01-01", 1.0, 1.0),
                 *[buy("lost", "2022-01-01", 1.0, 10.0, crisis=c) for c in ("c1", "c2")])
    estimates = frame(
        "wallet_address string, crisis_id string, estimated_profit_pct double, estimated_profit_usd double",
        ("best", "c1", 50.0, 5.0), ("best", "c2", 50.0, 5.0), ("once", "c1", 30.0, 3.0), ("once", "c1", 30.0, 3.0),
        # One gain, and a larger loss that the threshold would have hidden.
        ("lost", "c1", 20.0, 2.0), ("lost", "c2", -60.0, -6.0))
    got = labels.wallet_labels(buys, estimates, updated_at=F.lit(at("2022-06-01")))
    assert rows(got) == [
        ("best", "elite", 2, 2, 1.0, 50.0, 10.0, at("2022-06-01")),
        ("lost", "profitable", 2, 1, 0.5, -20.0, -4.0, at("2022-06-01")),
        ("none", "participant", 1, 0, 0.0, 0.0, 0.0, at("2022-06-01")),
        ("once", "profitable", 2, 1, 0.5, 20.0, 6.0, at("2022-06-01"))]


def test_hours_after_the_crash(frame):
    events = frame(EVENTS, event("c1", "T", "2022-01-01", "2022-01-09"))
    times = ["2022-01-01 11:59:59", "2022-01-01 12:00:00", "2022-01-04 12:00:00", "2022-01-04 12:00:01"]
    got = labels.buys_after_crash(frame(BUYS, *[buy("w", t, 1.0, 1.0) for t in times]), events)
    assert rows(got, "first_buy_timestamp") == [(at(times[1]),), (at(times[2]),)]


TRADED = "wallet_address string, token_address string, traded_at timestamp, bought double, sold double, price double"


def walk(trades, recovery_days):
    """One trade after the other."""
    books = {}
    for wallet, token, when, bought, sold, price in sorted(trades, key=lambda t: (t[2], (t[4] or 0) > 0)):
        b = books.setdefault((wallet, token), {"last": None, "held": 0.0, "in": 0.0, "cost": 0.0, "out": 0.0, "closed": 0.0, "profit": 0.0})
        if bought:
            b["last"] = when
            b["held"], b["in"], b["cost"] = b["held"] + bought, b["in"] + bought, b["cost"] + bought * price
        if sold and b["last"] and (when.date() - b["last"].date()).days <= recovery_days:
            closed = min(sold, b["held"])
            b["out"], b["held"], b["closed"] = b["out"] + sold, b["held"] - closed, b["closed"] + closed
            b["profit"] += closed * (price - b["cost"] / b["in"])
    return sorted((*k, *(round(b[x], 6) for x in ("in", "out", "closed", "profit"))) for k, b in books.items() if b["closed"])


def test_realised_profit_in_the_order_of_trades(frame):
    trades = [("w", "T", at("2022-01-01"), None, 5.0, 9.0),  # before any buy: does not count
              ("w", "T", at("2022-01-02"), 2.0, None, 1.0), ("w", "T", at("2022-01-03"), None, 1.0, 3.0),
              ("w", "T", at("2022-01-04"), 2.0, None, 4.0), ("w", "T", at("2022-01-05"), None, 9.0, 5.0),
              ("w", "T", at("2022-06-01"), None, 1.0, 99.0),  # too late
              ("v", "T", at("2022-01-01"), 1.0, None, 1.0), ("v", "U", at("2022-01-02"), None, 1.0, 1.0)]
    got = [(*r[:2], *(round(x, 6) for x in r[2:])) for r in rows(labels.realised_profit(frame(TRADED, *trades), 90))]
    # 1 at 3 - 1, then 3 at 5 - 10/4.
    assert got == walk(trades, 90) == [("w", "T", 4.0, 10.0, 4.0, 9.5)]


def test_realised_profit_equals_a_walk(frame):
    rng = random.Random(9)
    trades = []
    for _ in range(400):
        buys = rng.random() < 0.5
        trades.append((rng.choice("abc"), rng.choice("TU"), at(f"2022-0{rng.randrange(1, 6)}-{rng.randrange(1, 28):02} {rng.randrange(24):02}:00:00"),
                       float(rng.randrange(1, 9)) if buys else None, None if buys else float(rng.randrange(1, 9)), float(rng.randrange(1, 20))))
    # The price of a token is that of its moment.
    prices = {}
    trades = [(*t[:5], prices.setdefault((t[1], t[2]), t[5])) for t in trades]
    got = [(*r[:2], *(round(x, 6) for x in r[2:])) for r in rows(labels.realised_profit(frame(TRADED, *trades), 10))]
    assert got == walk(trades, 10)


@pytest.mark.parametrize("walk_rows", [1, 3, 50])
def test_realised_profit_in_slices(frame, walk_rows):
    """Slices of a few trades: buys, sales too late, and sales of more than is held, on either side of every cut."""
    rng = random.Random(walk_rows)
    trades, prices = [], {}
    for _ in range(400):
        when = at(f"2022-0{rng.randrange(1, 6)}-{rng.randrange(1, 28):02} {rng.randrange(24):02}:00:00")
        token, buys = rng.choice("TU"), rng.random() < 0.4
        trades.append((rng.choice("aaaab"), token, when, float(rng.randrange(1, 9)) if buys else None,
                       None if buys else float(rng.randrange(1, 9)), prices.setdefault((token, when), float(rng.randrange(1, 20)))))
    got = labels.realised_profit(frame(TRADED, *trades), 4, walk_rows=walk_rows)
    assert [(*r[:2], *(round(x, 6) for x in r[2:])) for r in rows(got)] == walk(trades, 4)


def test_a_busy_wallet_is_walked_by_many_tasks(spark):
    """One wallet with a million trades: no task walks through more than a few slices' worth of them."""
    trades = spark.range(1_000_000).selectExpr(
        "'bot' AS wallet_address", "'T' AS token_address", "timestamp_seconds(1600000000 + id * 7) AS traded_at",
        "CASE WHEN id % 3 = 0 THEN 4.0D END AS bought", "CASE WHEN id % 3 <> 0 THEN 2.0D END AS sold", "double(1 + id % 7) AS price")
    sliced = labels.realised_profit(trades, 90, walk_rows=50_000)
    plain = labels.realised_profit(trades, 90, walk_rows=10_000_000)
    assert [tuple(round(x, 3) if isinstance(x, float) else x for x in r) for r in sliced.collect()] == [
        tuple(round(x, 3) if isinstance(x, float) else x for x in r) for r in plain.collect()]
    cut = scale.in_slices(trades.select("wallet_address", "token_address", "traded_at"), ["wallet_address", "token_address"], ["traded_at"], 20)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 150_000


def test_short_slices_do_not_make_tasks(spark, monkeypatch):
    """Slices of two trades: far fewer ranges are made than slices, and rows of one moment stay in one slice."""
    trades = spark.range(3_000).selectExpr(
        "'w' || id % 7 AS wallet_address", "'T' AS token_address", "timestamp_seconds(1600000000 + id DIV 14) AS traded_at")
    pair = ["wallet_address", "token_address"]
    cut = scale.in_slices(trades, pair, ["traded_at"], 2, most=2)
    assert cut.count() == 3_000
    sizes = cut.groupBy(*pair, "_slice").agg(F.count("*").alias("n"), F.min("traded_at").alias("a"), F.max("traded_at").alias("b"))
    found = sorted(sizes.collect(), key=lambda r: (r.wallet_address, r._slice))
    assert max(r.n for r in found) == 2 and len({r._slice >> 32 for r in found}) == 2
    assert all(x.b < y.a for x, y in zip(found, found[1:]) if x.wallet_address == y.wallet_address)
    priced = trades.selectExpr("*", "IF(traded_at < timestamp_seconds(1600000100), 2.0D, NULL) AS bought",
                               "IF(traded_at < timestamp_seconds(1600000100), NULL, 1.0D) AS sold", "3.0D AS price")
    assert rows(labels.realised_profit(priced, 90, walk_rows=2)) == rows(labels.realised_profit(priced, 90))
    ranges = []
    monkeypatch.setattr(labels, "in_slices", lambda *a: ranges.append(a[3]) or scale.in_slices(*a))
    labels.realised_profit(priced, 90, walk_rows=2)
    assert ranges == [1]


def test_realised_profit_of_nothing(frame):
    assert labels.realised_profit(frame(TRADED)).collect() == []


@pytest.mark.parametrize("most", [None, 0])
def test_daily_median(frame, most):
    import statistics

    rng = random.Random(1)
    data = [(day(f"2022-01-0{d}"), float(rng.randrange(20))) for d in range(1, 6) for _ in range(d * 3)] + [(day("2022-01-09"), None)]
    data += [(day("2022-02-01"), v) for v in (5.0,) * 40] + [(day("2022-02-02"), v) for v in (-1e12, 1.0, 1.0 + 1e-9, 1.0 + 2e-9, 3.0, 1e15)]
    data += [(day("2022-02-03"), rng.gauss(0, 1)) for _ in range(3_001)]
    expected = {d: statistics.median(v for e, v in data if e == d) for d in {e for e, v in data if v is not None}}
    got = crisis.daily_median(frame("dt date, v double", *data), "dt", "v", most)
    assert {r.dt: r["median"] for r in got.collect()} == pytest.approx(expected, rel=1e-15)
    assert crisis.daily_median(frame("dt date, v double", (day("2022-01-01"), None)), "dt", "v", most).collect() == []


def test_samples_do_not_depend_on_partitions(frame):
    df = frame("k long, v string", *[(k, "x") for k in range(500)], (None, "y"))
    picked = [sorted(r.k for r in quality.sample_rows(df.repartition(p), 9, seed=3).collect()) for p in (1, 4, 30)]
    assert picked[0] == picked[1] == picked[2] and len(set(picked[0])) == 9
    assert picked[0] != sorted(r.k for r in quality.sample_rows(df, 9, seed=4).collect())
    assert quality.sample_rows(df, 1_000).count() == 501


def test_sketches_add_up(spark):
    df = spark.range(60_000).selectExpr("id % 20000 AS a", "id % 7 AS b", "timestamp_seconds(1600000000 + id * 20) AS t")
    sketches = quality.daily_sketches(df, "t", "a", "b")
    whole = quality.distinct_estimates(sketches, "a", "b").first()
    assert whole.row_count == 60_000 and whole.distinct_b == 7
    assert abs(whole.distinct_a - 20_000) <= quality.SKETCH_BOUND * 20_000
    one = quality.distinct_estimates(sketches, "a", first="2020-09-15", last="2020-09-15").first()
    true = df.where("to_date(t) = '2020-09-15'")
    assert one.row_count == true.count() and abs(one.distinct_a - true.count()) <= quality.SKETCH_BOUND * true.count()
    assert tuple(quality.distinct_estimates(sketches, "a", first="2030-01-01").first()) == (0, 0)


def test_activity_is_filtered_before_it_is_counted(frame, monkeypatch):
    logs = frame(LOGS, *[swap(f"2020-01-0{d}", "t", p, "0x") for d in range(1, 8) for p in ("p1", "p2", "other")])
    pools = frame("pool_address string", ("P1",), ("p2",), ("p9",), (None,))
    expected = [("p1", 7, at("2020-01-01"), at("2020-01-07")), ("p2", 7, at("2020-01-01"), at("2020-01-07"))]
    named = quality.pool_activity(logs, pools)
    assert rows(named) == expected and "Join" not in named._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(quality, "NAMED_POOLS", 1)
    joined = quality.pool_activity(logs, pools)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows(joined) == expected and plan.index("Aggregate") < plan.index("Join LeftSemi")
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)
    shuffled = quality.pool_activity(logs, pools)
    plan = shuffled._jdf.queryExecution().optimizedPlan().toString()
    assert rows(shuffled) == expected and plan.index("Join LeftSemi") < plan.index("Aggregate")


def test_activity_skips_by_address(spark, frame, tmp_path):
    from slumptrace.plans.jobs import store_logs

    store_logs(frame(LOGS, swap("2020-01-02", "t", "P1", "0x"), swap("2020-01-02", "t", "p2", "0x")), str(tmp_path / "logs"))
    found = quality.pool_activity(spark.read.parquet(str(tmp_path / "logs")), frame("pool_address string", ("p1",)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(address,p1)" in plan and rows(found, "pool_address") == [("p1",)]


def test_nan_prices_are_no_profit(frame):
    from slumptrace.operators import profit
    from slumptrace.sources import readers

    staged = readers.staged_buys(frame(BUYS, buy("w", "2022-01-01", float("nan"), 1.0), buy("v", "2022-01-01", 1.0, 1.0)))
    history = frame(PRICES, ("t", 2.0, day("2022-01-05"))).withColumn("token_address", F.lit("t"))
    pnl = profit.estimate_pnl(staged.withColumn("token_address", F.lit("t")), history)
    assert rows(profit.kept_ratio(pnl)) == [(1, 1, 1.0, 100.0)]
