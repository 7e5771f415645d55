"""Rules around a crisis: its buy window, and the phase of each price day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slumptrace.functions.values import number
from slumptrace.operators.scale import materialize, number_rows, small_side
from slumptrace.sources import readers

# Days around a crisis that count as near, as the fall before it and as the recovery after it.
NEAR_DAYS = 7
DROP_DAYS_BEFORE = 3


def buy_windows(crises: DataFrame, window_days: int | Column) -> DataFrame:
    """Give each crisis an id in date order, and a window of ``window_days`` days from its date."""
    order = [F.asc("crisis_date"), F.asc("token_address"), F.asc("crisis_name")]
    days = window_days if isinstance(window_days, Column) else F.lit(window_days)
    return number_rows(crises, order, name="_position").select(
        F.format_string("crisis_%03d", "_position").alias("crisis_id"),
        "token_address", "crisis_date", "crisis_name",
        F.col("crisis_date").alias("window_start_date"),
        F.date_add("crisis_date", days.cast("int")).alias("window_end_date"),
        F.col("crisis_date").alias("dt"),
    )


def first_crisis_order(events: DataFrame) -> DataFrame:
    """Tokens numbered by the date of their first crisis."""
    first = events.groupBy("token_address").agg(F.min("crisis_date").alias("first_crisis_date"))
    order = [F.asc("first_crisis_date"), F.asc("token_address")]
    return number_rows(first, order, name="position").select("token_address", "first_crisis_date", "position")


def crisis_phase(history: DataFrame, events: DataFrame) -> DataFrame:
    """Tag each price day ``drop``, ``recovery``, ``near`` or ``normal``.

    Of several crises around a day the latest one in a fall or recovery decides. Each crisis is laid out
    over the days around it, so the days are found by equality.
    """
    around = events.select(
        "token_address", "crisis_date", "crisis_id",
        F.explode(F.sequence(F.lit(-NEAR_DAYS), F.lit(NEAR_DAYS))).alias("ahead"),
    ).select(
        "token_address",
        F.date_sub("crisis_date", F.col("ahead")).alias("dt"),
        F.when(F.col("ahead").between(0, DROP_DAYS_BEFORE), "drop").when(F.col("ahead") < 0, "recovery").alias("phase"),
        F.struct("crisis_date", "crisis_id").alias("crisis"),
    )
    moving = F.when(F.col("phase").isNotNull(), F.col("crisis"))
    tagged = around.groupBy("token_address", "dt").agg(
        F.coalesce(F.max_by("phase", moving), F.lit("near")).alias("phase")
    )
    return history.join(small_side(tagged), ["token_address", "dt"], "left").select(
        "token_address", "dt", F.coalesce("phase", F.lit("normal")).alias("phase")
    )


# Days with more values than this are not brought together to find their median.
MEDIAN_ROWS = 100_000
# Ranges of values that a round of the search tells apart on each day.
CELLS = 1_024


def daily_median(df: DataFrame, day: str, value: str, most: int | None = None) -> DataFrame:
    """The median of ``value`` per day; ``df`` should be a stored result.

    Days of up to ``most`` values are aggregated as they are. Otherwise the median is searched for by narrowing
    (:func:`_narrowed_medians`), and only counts are shuffled.
    """
    values = df.select(F.col(day).alias("day"), F.col(value).cast("double").alias("value")).where(F.col(value).isNotNull())
    largest = values.groupBy("day").count().agg(F.max("count")).first()[0] or 0
    if largest <= (MEDIAN_ROWS if most is None else most):
        found = values.groupBy("day").agg(F.median("value").alias("median"))
    else:
        found = _narrowed_medians(values)
    return found.withColumnRenamed("day", day)


def _narrowed_medians(values: DataFrame) -> DataFrame:
    """Medians from histograms, however many values a day has.

    Each round cuts the range left of a day into equal cells and counts them, which tasks do on their own before
    anything is shuffled. If the two middle values (one, of an odd number) lie in one cell, its values are what is
    left; if not, they are the greatest of one cell and the least of the next. A cell of one value is the answer.
    Least and greatest value of a range fall into different cells, so every round gets closer.
    """
    n = F.col("n")
    left = materialize(values.groupBy("day").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).select(
        "day", "low", "high", F.floor((n + 1) / 2).alias("a"), (F.floor(n / 2) + 1).alias("b")), "ranges")
    done = None
    while True:
        cell = F.when(F.col("low") == F.col("high"), 0).otherwise(
            F.least(F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * CELLS), F.lit(CELLS - 1)))
        counted = values.join(small_side(left), "day").where("value BETWEEN low AND high").groupBy(
            "day", "a", "b", cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        before = Window.partitionBy("day").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))

        def holds(rank: str) -> Column:
            return (F.col(rank) > F.col("before")) & (F.col(rank) <= F.col("before") + F.col("n"))

        first, second = (F.when(holds(r), F.struct("cell", "before", "low", "high")) for r in ("a", "b"))
        middle = materialize(ranked.groupBy("day", "a", "b").agg(F.max(first).alias("x"), F.max(second).alias("y")), "middle")
        apart = (F.col("x.cell") < F.col("y.cell")) | (F.col("x.low") == F.col("x.high"))
        found = middle.where(apart).select("day", ((F.col("x.high") + F.col("y.low")) / 2).alias("median"))
        done = found if done is None else done.union(found)
        left = materialize(middle.where(~apart).select(
            "day", "x.low", "x.high", (F.col("a") - F.col("x.before")).alias("a"), (F.col("b") - F.col("x.before")).alias("b")), "ranges")
        if left.isEmpty():
            return done


def detect_crises(
    history: DataFrame,
    max_return_pct: float = -20.0,
    max_excess_pct: float = -15.0,
    lookback_days: int = 7,
    max_drain_pct: float | None = None,
) -> DataFrame:
    """Days on which a token fell sharply, and clearly more than the market did.

    The fall is measured against the highest price of the days before; the market is the median fall of
    all tokens quoted that day, so a general drop does not count. Of consecutive days the first is kept.
    With ``max_drain_pct`` a day also counts when the token's liquidity is that much below its highest of the days
    before; ``drain_pct`` is then part of the result.
    """
    quotes = readers.prices(history).where(F.col("price_usd") > 0)
    by_day = Window.partitionBy("token_address").orderBy(F.unix_date("dt"))
    before = by_day.rangeBetween(-lookback_days, -1)
    high = F.max("price_usd").over(before)
    moves = quotes.select(
        "token_address", "dt", ((F.col("price_usd") - high) / high * 100.0).alias("return_pct")
    ).where(F.col("return_pct").isNotNull())
    moves = materialize(moves, "moves")
    market = daily_median(moves, "dt", "return_pct").withColumnRenamed("median", "market_return_pct")
    wanted = (F.col("return_pct") <= max_return_pct) & (F.col("return_pct") - F.col("market_return_pct") <= max_excess_pct)
    # One row per day at most, as many as the calendar has.
    moves = moves.join(market, "dt")
    columns = ["return_pct", "market_return_pct"]
    if max_drain_pct is not None:
        pools = history.groupBy(F.lower("token_address").alias("token_address"), F.col("dt").cast("date").alias("dt")).agg(
            F.max(number(F.col("liquidity_usd"))).alias("liquidity_usd")).where("liquidity_usd IS NOT NULL")
        most = F.max("liquidity_usd").over(before)
        drains = pools.select(
            "token_address", "dt", (F.try_divide(F.col("liquidity_usd") - most, most) * 100.0).alias("drain_pct"))
        moves = moves.join(drains, ["token_address", "dt"], "full")
        wanted = F.coalesce(wanted, F.lit(False)) | F.coalesce(F.col("drain_pct") <= max_drain_pct, F.lit(False))
        columns.append("drain_pct")
    gap = F.datediff("dt", F.lag("dt").over(by_day))
    return moves.where(wanted).withColumn("gap", gap).where(F.col("gap").isNull() | (F.col("gap") > 1)).select(
        "token_address", F.col("dt").alias("crisis_date"), *columns
    )


def detected_events(found: DataFrame, window_days: int) -> DataFrame:
    """Detected crises as rows of the crisis table: named after token and day, numbered and with their windows."""
    named = found.select(
        "token_address", "crisis_date",
        F.concat(F.lit("Crash of "), "token_address", F.lit(" on "), F.col("crisis_date").cast("string")).alias("crisis_name"))
    return buy_windows(named, window_days)
