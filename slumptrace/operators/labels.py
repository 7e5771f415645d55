"""Wallet-level results: buyer rollups, labels and realised profit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slumptrace.constants import MIN_PROFIT_PCT, RECOVERY_DAYS
from slumptrace.operators.scale import in_slices, materialize, small_side


def buyer_rollup(buys: DataFrame) -> DataFrame:
    """Buys per crisis, wallet and token: first time and price, totals, count and average price."""
    return buys.groupBy("crisis_id", "wallet_address", "token_address").agg(
        F.min("first_buy_timestamp").alias("first_buy_timestamp"),
        F.min(F.struct("first_buy_timestamp", "first_buy_price"))["first_buy_price"].alias("first_buy_price"),
        F.sum("total_amount_bought").alias("total_amount_bought"),
        F.sum("total_usd_spent").alias("total_usd_spent"),
        F.count("*").alias("num_transactions"),
        F.try_divide(F.sum("total_usd_spent"), F.sum("total_amount_bought")).alias("avg_buy_price"),
    )


def label_for(profited: Column, success_rate: Column) -> Column:
    """Label tiers: repeated gains in most crises, any gain, none."""
    return (
        F.when((profited >= 2) & (success_rate >= 0.75), "elite")
        .when(profited >= 1, "profitable")
        .otherwise("participant")
    )


def wallet_labels(
    buys: DataFrame, estimates: DataFrame, min_pct: float = MIN_PROFIT_PCT, updated_at: Column | None = None
) -> DataFrame:
    """Track record and label of every buyer.

    ``buys`` says which crises a wallet joined and what it spent, ``estimates`` what each buy gained or lost. Totals
    take in all estimates; only crises with a gain of ``min_pct`` percent count as profited. Both sides are added up
    per wallet before they meet, so a busy wallet is one row in the join.
    """
    joined = buys.groupBy("wallet_address").agg(
        F.count_distinct("crisis_id").alias("num_crisis_events"),
        F.sum("total_usd_spent").alias("spent"),
    )
    gained = estimates.groupBy("wallet_address").agg(
        F.count_distinct(F.when(F.col("estimated_profit_pct") >= min_pct, F.col("crisis_id"))).alias("total_profited_crises"),
        F.sum("estimated_profit_usd").alias("total_pnl_usdt"),
    )
    record = joined.join(gained, "wallet_address", "left").fillna(0, ["total_profited_crises", "total_pnl_usdt"])
    record = record.withColumn("success_rate", F.try_divide("total_profited_crises", "num_crisis_events"))
    return record.select(
        "wallet_address",
        label_for(F.col("total_profited_crises"), F.col("success_rate")).alias("label_value"),
        "num_crisis_events",
        "total_profited_crises",
        "success_rate",
        (F.try_divide("total_pnl_usdt", "spent") * 100.0).alias("total_pnl_pct"),
        "total_pnl_usdt",
        (F.current_timestamp() if updated_at is None else updated_at).alias("last_updated_timestamp"),
    )


def hours_after(time: Column, crisis_date: Column, hours: tuple[int, int]) -> Column:
    """Whether a time lies within these hours after the start of the crisis day, to the second and both included."""
    crash = crisis_date.cast("timestamp")
    return time.between(*[crash + F.make_interval(hours=F.lit(h)) for h in hours])


def buys_after_crash(buys: DataFrame, events: DataFrame, from_hours: int = 12, to_hours: int = 84) -> DataFrame:
    """Buys made ``from_hours`` to ``to_hours`` after the start of their crisis day.

    The buys must come from windows that reach as far; ``StageOneOptions.hours`` sees to that.
    """
    starts = small_side(events.select("crisis_id", "crisis_date"))
    inside = hours_after(F.col("first_buy_timestamp"), F.col("crisis_date"), (from_hours, to_hours))
    return buys.join(starts, "crisis_id").where(inside).select(*buys.columns)


# A wallet and token with more trades than this are not walked through in one task.
WALK_ROWS = 200_000
# However short the slices are, a task takes about as many trades as this.
TASK_TRADES = 20_000
_PAIR = ["wallet_address", "token_address"]
_TIME = ["traded_at", "is_sale"]


def realised_profit(
    trades: DataFrame, recovery_days: int = RECOVERY_DAYS, rows: int | None = None, largest: int | None = None,
    walk_rows: int | None = None,
) -> DataFrame:
    """Profit of what a wallet sold again, per wallet and token, against its average cost up to each sale.

    ``trades`` has ``wallet_address, token_address, traded_at, bought, sold, price``, one of the amounts per row. A
    sale counts within ``recovery_days`` of the last buy before it, and closes no more than is held then: with ``B``
    bought and ``S`` sold so far, ``S + min(0, least B - S so far)`` has been closed. So running sums and one running
    minimum say it all, without a loop over the trades. Buys come before sales of the same moment.

    ``rows`` and ``largest`` are the number of trades, and that of the busiest wallet and token, if they are known.
    Where that one has more than ``walk_rows`` trades, the trades are cut into slices of wallet, token and time. Each
    slice is reduced to a few numbers per wallet and token; added up over the slices before it they are the state in
    which a slice begins, and it is walked through from there (:func:`_walk_slices`).
    """
    walk_rows = WALK_ROWS if walk_rows is None else walk_rows
    if largest is None or rows is None:
        sizes = trades.groupBy(*_PAIR).count()
        rows, largest = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    bought, sold = [F.when(F.col(c) > 0, F.col(c)).otherwise(0.0) for c in ("bought", "sold")]
    amounts = trades.select(
        *_PAIR, "traded_at", F.coalesce(F.col("sold") > 0, F.lit(False)).alias("is_sale"), bought.alias("bought"),
        sold.alias("sold"), "price")
    if largest > walk_rows:
        steps = _walk_slices(amounts, recovery_days, rows, walk_rows)
    else:
        steps = _closed(_walk(amounts, _PAIR, recovery_days, F.lit(None)), *[F.lit(0.0)] * 3, F.lit(None))
    margin = F.col("price") - F.try_divide("cost_sum", "in_sum")
    return steps.groupBy(*_PAIR).agg(
        F.sum("bought").alias("bought_amount"), F.sum("sold").alias("sold_amount"), F.sum("closed").alias("closed_amount"),
        F.sum(F.when(F.col("closed") > 0, F.col("closed") * margin)).alias("realised_profit_usd"),
    ).where("closed_amount > 0")


def _walk(amounts: DataFrame, part: list[str], recovery_days: int, last_before: Column) -> DataFrame:
    """Running sums, running minimum of what is left, and both before each trade, from the first trade of a part on.

    ``last_before`` is the day of the last buy before the part.
    """
    ordered = Window.partitionBy(*part).orderBy(*_TIME)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    day = F.to_date("traded_at")
    last_buy = F.coalesce(F.last(F.when(F.col("bought") > 0, day), ignorenulls=True).over(so_far), last_before.cast("date"))
    steps = amounts.withColumn(
        "sold", F.when(F.datediff(day, last_buy) <= recovery_days, F.col("sold")).otherwise(0.0)).withColumns({
            "in_sum": F.sum("bought").over(so_far),
            "cost_sum": F.sum(F.col("bought") * F.col("price")).over(so_far),
            "out_sum": F.sum("sold").over(so_far),
        })
    steps = steps.withColumn(
        "short", F.min(F.when(F.col("sold") > 0, F.col("in_sum") - F.col("out_sum"))).over(so_far))
    return steps.withColumns({
        "out_before": F.coalesce(F.lag("out_sum").over(ordered), F.lit(0.0)), "short_before": F.lag("short").over(ordered)})


def _closed(steps: DataFrame, start_in: Column, start_cost: Column, start_out: Column, start_short: Column) -> DataFrame:
    """What each trade closes, for parts that begin with the given sums and the given least difference."""
    held = start_in - start_out

    def closed_sum(out: str, short: str) -> Column:
        least = F.least(start_short.cast("double"), F.col(short) + held)
        return start_out + F.col(out) + F.least(F.lit(0.0), F.coalesce(least, F.lit(0.0)))

    closed = F.when(F.col("sold") > 0, closed_sum("out_sum", "short") - closed_sum("out_before", "short_before")).otherwise(0.0)
    return steps.withColumns({
        "closed": closed, "in_sum": F.col("in_sum") + start_in, "cost_sum": F.col("cost_sum") + start_cost})


def _walk_slices(amounts: DataFrame, recovery_days: int, rows: int, walk_rows: int) -> DataFrame:
    """The steps of :func:`_walk` and :func:`_closed`, slice by slice.

    Sales count by the last buy before them, so its day is carried over first; sums and the least difference follow.
    Trades are cut into ranges for tasks, and in these a wallet and token into slices of ``walk_rows``. Only a wallet and
    token that lie in several slices begin anywhere but at nothing: two per range at most that cross its ends, and those
    with more than ``walk_rows`` trades. So the states are few, however many wallets there are; beyond the size of a
    broadcast they are joined by a shuffle.
    """
    part = [*_PAIR, "_slice"]
    ranges = -(-rows // max(walk_rows, TASK_TRADES))
    sliced = in_slices(amounts, _PAIR, _TIME, ranges, "trades", walk_rows)
    most_states = 2 * (ranges + -(-rows // walk_rows))
    group = Window.partitionBy(*_PAIR)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)

    def with_states(trades: DataFrame, states: DataFrame) -> DataFrame:
        return trades.join(small_side(materialize(states.where("_slices > 1").drop("_slices"), "states"), most_states), part, "left")

    several = F.count("*").over(group).alias("_slices")
    last = sliced.groupBy(*part).agg(F.max(F.when(F.col("bought") > 0, F.to_date("traded_at"))).alias("last"))
    last = last.select(*part, F.max("last").over(earlier).alias("start_last"), several)
    steps = materialize(_walk(with_states(sliced, last), part, recovery_days, F.col("start_last")).drop("start_last"), "walked")
    sums = steps.groupBy(*part).agg(
        F.sum("bought").alias("i"), F.sum(F.col("bought") * F.col("price")).alias("c"), F.sum("sold").alias("o"), F.min("short").alias("m"))
    before = sums.select(*part, "m", several, *[
        F.coalesce(F.sum(x).over(earlier), F.lit(0.0)).alias(name) for x, name in (("i", "start_in"), ("c", "start_cost"), ("o", "start_out"))])
    before = before.withColumn("start_short", F.min(F.col("m") + F.col("start_in") - F.col("start_out")).over(earlier)).drop("m")
    starts = [F.coalesce(c, F.lit(0.0)) for c in ("start_in", "start_cost", "start_out")]
    return _closed(with_states(steps, before), *starts, F.col("start_short"))
