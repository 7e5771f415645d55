"""Daily prices seen from a buy: the price valid on its day, and the peak in the days after.

Many buys share a token and a day, so prices are looked up once per distinct pair. The pairs are merged
into the price rows of their token, where ordered windows answer them, and are then joined back to the
buys by plain equality. A token has at most one price and one pair per day, which bounds each window.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slumptrace.constants import DEFAULT_PRICE, MOVE_OFFSET_DAYS, RECOVERY_DAYS
from slumptrace.functions.values import number, pct_change
from slumptrace.operators import scale
from slumptrace.operators.scale import small_side
from slumptrace.sources import readers

_KEYS = ["token_address", "buy_date"]


@dataclass(frozen=True)
class BuyDays:
    """The distinct (token, day) pairs of some buys, an upper bound of their number, and their range."""

    pairs: DataFrame
    count: int
    first: date | None
    last: date | None


def buy_days(buys: DataFrame, timestamp: str = "first_buy_timestamp") -> BuyDays:
    """Measure the pairs of ``buys``, which should be a stored result.

    Few buys have few pairs; of many buys the pairs themselves are counted.
    """
    dated = buys.select("token_address", F.to_date(timestamp).alias("buy_date"))
    row = dated.agg(F.count("*").alias("n"), F.min("buy_date").alias("lo"), F.max("buy_date").alias("hi")).first()
    pairs = dated.distinct()
    count = row["n"] if row["n"] <= scale.BROADCAST_ROWS else pairs.count()
    return BuyDays(pairs, count, row["lo"], row["hi"])


def _join_back(buys: DataFrame, timestamp: str, answers: DataFrame, days: BuyDays, how: str) -> DataFrame:
    # There is at most one answer per pair, and the pairs have been counted.
    side = small_side(answers, days.count)
    return buys.withColumn("buy_date", F.to_date(timestamp)).join(side, _KEYS, how)


def _merged(quotes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Price rows and asked pairs of all tokens, told apart by ``asked``."""
    return quotes.select(
        "token_address", "dt", "price_usd", F.lit(False).alias("asked")
    ).unionByName(
        pairs.select(
            "token_address", F.col("buy_date").alias("dt"),
            F.lit(None).cast("double").alias("price_usd"), F.lit(True).alias("asked"),
        )
    )


def _beside(pairs: DataFrame, history: DataFrame) -> DataFrame:
    """Pairs dealt out as the buckets of a stored price history are, which then need not move."""
    buckets = readers.stored_buckets(history)
    return pairs.repartition(buckets, "token_address") if buckets else pairs


def asof_prices(history: DataFrame, days: BuyDays, clip_history: bool = True) -> DataFrame:
    """Per asked pair: the latest price up to that day, or else the token's first price.

    A price row counts even if its price is null. With ``clip_history`` only prices between the first and
    the last asked day are seen. Pairs of tokens without any price row are left out.
    """
    first, last = (days.first, days.last) if clip_history else (None, None)
    rows = _merged(readers.prices(history, days.pairs, first, last, days.count), _beside(days.pairs, history))
    quote = F.when(~F.col("asked"), F.struct("dt", "price_usd"))
    token = Window.partitionBy("token_address")
    # On the same day the price row comes before the asked pair.
    so_far = token.orderBy("dt", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.select(
        "token_address", "dt", "asked",
        F.coalesce(F.last(quote, ignorenulls=True).over(so_far), F.min(quote).over(token)).alias("quote"),
    )
    return found.where(F.col("asked") & F.col("quote").isNotNull()).select(
        "token_address", F.col("dt").alias("buy_date"),
        F.col("quote.price_usd").alias("price_usd"), F.lit(True).alias("quoted"),
    )


def price_buys(
    buys: DataFrame,
    history: DataFrame,
    clip_history: bool = True,
    default_price: float = DEFAULT_PRICE,
    timestamp: str = "first_buy_timestamp",
    amount: str = "total_amount_bought",
    days: BuyDays | None = None,
) -> DataFrame:
    """Add ``first_buy_price`` and ``total_usd_spent``; tokens never priced get ``default_price``."""
    days = buy_days(buys, timestamp) if days is None else days
    priced = _join_back(buys, timestamp, asof_prices(history, days, clip_history), days, "left")
    price = F.when(F.col("quoted"), F.col("price_usd")).otherwise(F.lit(default_price))
    return priced.select(
        *buys.columns,
        price.alias("first_buy_price"),
        (F.col(amount) * price).alias("total_usd_spent"),
    )


def peak_prices(history: DataFrame, days: BuyDays, recovery_days: int = RECOVERY_DAYS) -> DataFrame:
    """Per asked pair: the highest price in the ``recovery_days`` days after it, and its earliest day."""
    first, last = (
        (days.first + timedelta(days=1), days.last + timedelta(days=recovery_days)) if days.count else (None, None)
    )
    quotes = readers.prices(history, days.pairs, first, last, days.count)
    rows = _merged(quotes.where(F.col("price_usd").isNotNull()), _beside(days.pairs, history))
    after = Window.partitionBy("token_address").orderBy(F.unix_date("dt")).rangeBetween(1, recovery_days)
    # The smallest negated price with the smallest day is the earliest peak.
    best = F.min(F.when(~F.col("asked"), F.struct((-F.col("price_usd")).alias("negated"), "dt"))).over(after)
    return rows.select("token_address", "dt", "asked", best.alias("best")).where(
        F.col("asked") & F.col("best").isNotNull()
    ).select(
        "token_address", F.col("dt").alias("buy_date"),
        (-F.col("best.negated")).alias("peak_price"), F.col("best.dt").alias("peak_date"),
    )


def peak_after(
    buys: DataFrame,
    history: DataFrame,
    recovery_days: int = RECOVERY_DAYS,
    timestamp: str = "first_buy_timestamp",
    days: BuyDays | None = None,
) -> DataFrame:
    """Buys with the peak that followed them; buys without a later price are left out."""
    days = buy_days(buys, timestamp) if days is None else days
    peaks = peak_prices(history, days, recovery_days)
    return _join_back(buys, timestamp, peaks, days, "inner").select(*buys.columns, "peak_price", "peak_date")


def price_at_offsets(events: DataFrame, history: DataFrame, offset_days: int = MOVE_OFFSET_DAYS) -> DataFrame:
    """Price before the crisis, on its day and after its window, with the two percent changes.

    The three days of every crisis are looked up in a single pass over the price history.
    """
    asked = F.array(
        F.struct(F.lit("before").alias("moment"), F.date_sub("crisis_date", offset_days).alias("dt")),
        F.struct(F.lit("during").alias("moment"), F.col("crisis_date").alias("dt")),
        F.struct(F.lit("after").alias("moment"), F.date_add("window_end_date", offset_days).alias("dt")),
    )
    probes = events.select(
        "crisis_id", F.lower("token_address").alias("token_address"), F.explode(asked).alias("probe")
    ).select("crisis_id", "token_address", "probe.moment", "probe.dt")
    quotes = history.select(
        F.lower("token_address").alias("token_address"), "dt", number(F.col("price_usd")).alias("price_usd")
    )

    def at(moment: str, name: str):
        return F.max(F.when(F.col("moment") == moment, F.col("price_usd"))).alias(name)

    found = quotes.join(small_side(probes), ["token_address", "dt"]).groupBy("crisis_id").agg(
        at("before", "price_before_crisis"), at("during", "price_during_crisis"), at("after", "price_after_recovery")
    )
    before, during, after = (
        F.col(c) for c in ("price_before_crisis", "price_during_crisis", "price_after_recovery")
    )
    return events.join(found, "crisis_id", "left").select(
        "crisis_id", "token_address", "crisis_date", "window_start_date", "window_end_date",
        before, during, after,
        F.round(pct_change(before, during), 2).alias("crisis_drop_pct"),
        F.round(pct_change(during, after), 2).alias("recovery_gain_pct"),
    )
