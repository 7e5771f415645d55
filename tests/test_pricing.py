import random
from datetime import date, timedelta

import pytest

from helpers import EVENTS, PRICES, at, day, event, rows
from slumptrace.operators import pricing, scale
from slumptrace.sources import readers

NAN = float("nan")
BUYS = "id int, token_address string, first_buy_timestamp timestamp, total_amount_bought double"


def price(frame, buys, prices, **options):
    df = frame(BUYS, *[(i, token, at(when), 2.0) for i, (token, when) in enumerate(buys)])
    priced = pricing.price_buys(df, frame(PRICES, *[(t, p, day(d)) for t, p, d in prices]), **options)
    return {r["id"]: (r["first_buy_price"], r["total_usd_spent"]) for r in priced.collect()}


HISTORY = [("a", 1.0, "2022-01-01"), ("a", 3.0, "2022-01-03"), ("b", 7.0, "2022-01-08"), ("n", 5.0, "2022-01-02"),
           ("n", None, "2022-01-04"), ("q", 5.0, "2022-01-02"), ("q", NAN, "2022-01-04")]


def test_asof_over_the_whole_history(frame):
    buys = [("a", "2022-01-03 23:00:00"), ("a", "2022-01-02 01:00:00"), ("a", "2021-12-31 01:00:00"),
            ("a", "2022-02-01 01:00:00"), ("b", "2022-01-05"), ("none", "2022-01-05"), ("n", "2022-01-05"), ("q", "2022-01-05")]
    assert price(frame, buys, HISTORY, clip_history=False) == {
        0: (3.0, 6.0), 1: (1.0, 2.0), 2: (1.0, 2.0), 3: (3.0, 6.0), 4: (7.0, 14.0), 5: (1.0, 2.0),
        6: (None, None), 7: (None, None)}


def test_asof_within_the_days_of_the_buys(frame):
    buys = [("a", "2022-01-02"), ("a", "2022-01-05"), ("b", "2022-01-05"), ("n", "2022-01-03")]
    # Earlier prices are out of sight: the later price is the first one left, or there is none.
    assert price(frame, buys, HISTORY) == {0: (3.0, 6.0), 1: (3.0, 6.0), 2: (1.0, 2.0), 3: (5.0, 10.0)}
    assert price(frame, buys, HISTORY, default_price=9.0)[2] == (9.0, 18.0)


def test_no_prices_and_no_buys(frame):
    assert price(frame, [("a", "2022-01-02")], []) == {0: (1.0, 2.0)}
    assert price(frame, [], HISTORY) == {}


def test_prices_are_unified_on_reading(frame):
    df = frame(PRICES, ("A", 1.0, day("2022-01-01")), ("a", 2.0, day("2022-01-01")), ("a", NAN, day("2022-01-02")))
    assert rows(readers.prices(df)) == [("a", day("2022-01-01"), 2.0), ("a", day("2022-01-02"), None)]


def peaks(frame, when, prices, **options):
    df = frame(BUYS, (1, "a", at(when), 2.0))
    history = frame(PRICES, *[("a", p, day(when[:10]) + timedelta(days=d)) for d, p in prices])
    got = pricing.peak_after(df, history, **options).collect()
    return [(r["peak_price"], (r["peak_date"] - day(when[:10])).days) for r in got]


@pytest.mark.parametrize("prices, expected", [
    ([(0, 9.0)], []), ([(1, 2.0)], [(2.0, 1)]), ([(90, 2.0)], [(2.0, 90)]), ([(91, 9.0)], []),
    ([(0, 9.0), (1, 2.0), (90, 3.0), (91, 9.0)], [(3.0, 90)]),
    ([(5, 4.0), (3, 4.0), (2, 1.0)], [(4.0, 3)]),
    ([(1, None), (2, NAN), (3, 1.0)], [(1.0, 3)]), ([(1, None)], []), ([(1, -2.0), (2, -1.0)], [(-1.0, 2)]),
])
def test_peak(frame, prices, expected):
    assert peaks(frame, "2022-03-01 13:00:00", prices) == expected


def test_peak_horizon_is_a_setting(frame):
    assert peaks(frame, "2022-03-01", [(3, 1.0), (4, 2.0)], recovery_days=3) == [(1.0, 3)]


@pytest.mark.parametrize("limit", [scale.BROADCAST_ROWS, 0])
def test_against_brute_force(frame, monkeypatch, limit):
    monkeypatch.setattr(scale, "BROADCAST_ROWS", limit)
    rng = random.Random(11)
    first = date(2022, 1, 1)
    quotes = {(t, first + timedelta(days=rng.randrange(250))): rng.choice([1.0, 2.0, 3.0, 4.0, None])
              for t in "abcd" for _ in range(60)}
    buys = [(i, rng.choice("abcde"), first + timedelta(days=rng.randrange(-20, 270))) for i in range(300)]
    df = frame(BUYS, *[(i, t, at(f"{d} 10:00:00"), 1.0) for i, t, d in buys])
    history = frame(PRICES, *[(t, p, d) for (t, d), p in quotes.items()])
    lo, hi = min(d for *_, d in buys), max(d for *_, d in buys)

    def asof(token, when, clip):
        seen = sorted((d, p) for (t, d), p in quotes.items() if t == token and (not clip or lo <= d <= hi))
        if not seen:
            return 1.0
        before = [p for d, p in seen if d <= when]
        return before[-1] if before else seen[0][1]

    for clip in (True, False):
        got = {r["id"]: r["first_buy_price"] for r in pricing.price_buys(df, history, clip).collect()}
        assert got == {i: asof(t, d, clip) for i, t, d in buys}

    expected = {}
    for i, token, when in buys:
        ahead = [(-p, d) for (t, d), p in quotes.items()
                 if t == token and p is not None and when < d <= when + timedelta(days=90)]
        if ahead:
            expected[i] = (-min(ahead)[0], min(ahead)[1])
    got = {r["id"]: (r["peak_price"], r["peak_date"]) for r in pricing.peak_after(df, history).collect()}
    assert got == expected


def test_prices_around_a_crisis(frame):
    events = frame(EVENTS, event("c1", "A", "2022-01-08", "2022-01-10"), event("c2", "a", "2022-02-08", "2022-02-10"))
    history = frame(PRICES, ("a", 100.0, day("2022-01-01")), ("a", 90.0, day("2022-01-08")), ("a", 99.0, day("2022-01-17")),
                    ("a", 0.0, day("2022-02-01")), ("a", 1.0, day("2022-02-08")), ("b", 5.0, day("2022-01-08")))
    got = pricing.price_at_offsets(events, history)
    assert rows(got, "crisis_id", "price_before_crisis", "price_during_crisis", "price_after_recovery",
                "crisis_drop_pct", "recovery_gain_pct") == [
        ("c1", 100.0, 90.0, 99.0, -10.0, 10.0), ("c2", 0.0, 1.0, None, None, None)]
