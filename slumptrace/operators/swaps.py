"""From swap logs to buys of a crisis token."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from slumptrace.constants import TOKEN_DECIMALS
from slumptrace.functions.hexdata import word_amount
from slumptrace.functions.logs import PROTOCOLS, Protocol
from slumptrace.functions.values import valid_wallet
from slumptrace.operators.scale import materialize, number_rows, small_side

# "abi" reads the amounts paid out where the payload keeps them. "shifted" reads one word earlier, which
# is needed to repeat results that were produced that way.
DECODE_SHIFT = {"abi": 0, "shifted": -1}


def latest(swaps: DataFrame, n: int) -> DataFrame:
    """The ``n`` latest swaps; ties are broken by hash, log index, pool and payload.

    A count per day finds the one day that is cut. Later days are kept whole and only that day is put
    in order, so no task ever holds ``n`` rows of every partition.
    """
    day = F.to_date("block_timestamp")
    newest_first = Window.orderBy(F.desc("day"))
    cut = (
        swaps.groupBy(day.alias("day")).agg(F.count("*").alias("rows"))
        .withColumn("total", F.sum("rows").over(newest_first))
        .where(F.col("total") >= n)
        .orderBy(F.desc("day"))
        .first()
    )
    if cut is None:
        return swaps
    room = n - (cut["total"] - cut["rows"])
    order = [F.desc("block_timestamp"), *[F.col(c) for c in ("transaction_hash", "log_index", "pool_address", "data")]]
    numbered = number_rows(swaps.where(day == F.lit(cut["day"])), order, name="_position", largest=cut["rows"])
    return swaps.where(day > F.lit(cut["day"])).unionByName(
        numbered.where(F.col("_position") <= room).drop("_position")
    )


def with_sender(swaps: DataFrame, senders: DataFrame) -> DataFrame:
    """Add the sender of the transaction as the wallet; unknown transactions leave it null.

    Senders that carry their ``block_date`` are joined by day and hash, so only the partitions of those days meet. Those
    stored in buckets of their hash stay where they are when swaps are too many to be broadcast: only swaps move.
    """
    if "block_date" not in senders.columns:
        return swaps.join(senders, "transaction_hash", "left")
    dated = swaps.withColumn("block_date", F.to_date("block_timestamp"))
    return dated.join(senders, ["block_date", "transaction_hash"], "left").select(*swaps.columns, "wallet_address")


def window_pieces(crisis_pools: DataFrame) -> DataFrame:
    """Windows cut into pieces of a binary tree over the days: added ``level`` and ``piece``.

    A piece of level ``l`` is the ``2 ** l`` days whose number, shifted right by ``l``, is ``piece``. A window is the
    union of at most two pieces of each level, so one of ``n`` days has at most ``2 * log2(n) + 1`` of them. From the
    bottom up, with the window as ``low <= day < high``, a level takes its first piece if that is a right half, and its last
    if that is a left half; halves that belong together are left to the next level.
    """
    start, end = F.unix_date("window_start_date"), F.unix_date("window_end_date") + 1

    def pieces(level: Column) -> Column:
        # Bounds in units of the level, the lower one rounded up.
        low = -F.call_function("shiftright", -start, level)
        high = F.call_function("shiftright", end, level)
        return F.array(
            F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), F.struct(level.alias("level"), low.alias("piece"))),
            F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), F.struct(level.alias("level"), (high - 1).alias("piece"))))

    levels = F.sequence(F.lit(0), F.floor(F.log2(end - start)).cast("int"))
    found = F.filter(F.flatten(F.transform(levels, pieces)), lambda x: x.isNotNull())
    return crisis_pools.where("window_start_date <= window_end_date").select("*", F.inline(found))


def in_windows(swaps: DataFrame, crisis_pools: DataFrame) -> DataFrame:
    """Swaps × crises of their pool, for block dates inside the window, both ends included.

    A swap that falls in several windows is kept once for each.
    """
    return in_pieces(swaps, materialize(window_pieces(crisis_pools), "pieces"))


def in_pieces(swaps: DataFrame, pieces: DataFrame) -> DataFrame:
    """:func:`in_windows` for windows that are stored in pieces.

    A day lies in one piece of each level, and each window that holds the day has exactly one of these. So swaps of the
    pools asked for are laid out over the levels that occur, and meet the windows of their day and no others: by
    equality, however long the windows are and however many a pool has.
    """
    size, levels = pieces.agg(F.count("*"), F.array_sort(F.collect_set("level"))).first()
    known = swaps.join(small_side(pieces.select("pool_address").distinct(), size), "pool_address", "left_semi")
    day = F.unix_date(F.to_date("block_timestamp"))
    above = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(day, k).alias("piece")) for k in levels or [0]])
    laid = known.select("*", F.inline(above))
    return laid.join(small_side(pieces, size), ["pool_address", "level", "piece"]).drop("level", "piece")


# One scale for both tokens, or one for each.
Decimals = int | Column | tuple[Column, Column]


def pool_decimals(pools: DataFrame, default: int | Column = TOKEN_DECIMALS) -> Decimals:
    """The decimals of both tokens where the pool dimension carries them, else ``default`` for both."""
    names = ("token0_decimals", "token1_decimals")
    if not set(names) <= set(pools.columns):
        return default
    return tuple(F.coalesce(F.col(c), default if isinstance(default, Column) else F.lit(default)) for c in names)


def out_amounts(
    decode: str = "abi",
    decimals: Decimals = TOKEN_DECIMALS,
    protocols: Sequence[Protocol] = PROTOCOLS,
    topic: Column | None = None,
) -> tuple[Column, Column]:
    """The amounts paid out of the pool in its first and second token; null for other protocols.

    With ``topic`` a swap counts only if it is the event of its pool's protocol.
    """
    shift = DECODE_SHIFT[decode]
    scale0, scale1 = decimals if isinstance(decimals, tuple) else (decimals, decimals)
    amount0 = amount1 = F.lit(None).cast("double")
    data = F.col("data")
    for layout in dict.fromkeys((p.out0_word, p.out1_word, p.swap_topic) for p in protocols):
        names = [p.name for p in protocols if (p.out0_word, p.out1_word, p.swap_topic) == layout]
        known = F.col("dex_protocol").isin(names)
        if topic is not None:
            known = known & (topic == layout[2])
        amount0 = F.when(known, word_amount(data, layout[0] + shift, scale0)).otherwise(amount0)
        amount1 = F.when(known, word_amount(data, layout[1] + shift, scale1)).otherwise(amount1)
    return amount0, amount1


def bought_amount(
    decode: str = "abi",
    decimals: Decimals = TOKEN_DECIMALS,
    protocols: Sequence[Protocol] = PROTOCOLS,
    topic: Column | None = None,
) -> Column:
    """The amount of the crisis token a swap paid out; null for payloads that are short or not hex."""
    amount0, amount1 = out_amounts(decode, decimals, protocols, topic)
    return F.when(F.col("token0_address") == F.col("crisis_token"), amount0).when(
        F.col("token1_address") == F.col("crisis_token"), amount1
    )


def sold_amount(
    decimals: Decimals = TOKEN_DECIMALS, protocols: Sequence[Protocol] = PROTOCOLS, topic: Column | None = None
) -> Column:
    """The amount of the crisis token a swap took in."""
    paid_in = [replace(p, out0_word=p.in0_word, out1_word=p.in1_word) for p in protocols]
    return bought_amount("abi", decimals, paid_in, topic)


def crisis_buys(
    swaps: DataFrame,
    decode: str = "abi",
    decimals: Decimals = TOKEN_DECIMALS,
    protocols: Sequence[Protocol] = PROTOCOLS,
) -> DataFrame:
    """Swaps in windows that paid out the crisis token, with the amount."""
    topic = F.col("swap_topic") if "swap_topic" in swaps.columns else None
    return swaps.withColumn("token_amount", bought_amount(decode, decimals, protocols, topic)).where(
        F.col("token_amount") > 0
    )


def by_valid_wallets(swaps: DataFrame) -> DataFrame:
    """Swaps whose sender is known and not the zero address."""
    return swaps.where(valid_wallet(F.col("wallet_address")))
