"""The same queries as SQL text for DuckDB, written in a different form where there is one."""

from __future__ import annotations

import re

from slumptrace.constants import (
    PAIR_CREATED_TOPIC, PAIR_FACTORY, SWAP_TOPIC, ZERO_ADDRESS,
)
from slumptrace.schemas import TABLES
from slumptrace.workload.queries import LATEST, SCAN_FROM, SCAN_UNTIL
from slumptrace.workload.views import TEST_TABLES, VIEWS, oracle_view


def _word(index: int) -> str:
    return f"CAST(concat('0x', substr(data, {3 + 64 * index}, 64)) AS UHUGEINT)"


def _amounts(first: int, second: int, protocols: str) -> str:
    return f"""
        SELECT *,
               CASE WHEN dex_protocol IN ({protocols}) THEN CAST({_word(first)} AS DOUBLE) / 1e18 END AS amount0,
               CASE WHEN dex_protocol IN ({protocols}) THEN CAST({_word(second)} AS DOUBLE) / 1e18 END AS amount1
        FROM o_windowed"""


_ONE, _TWO = "'Uniswap V2'", "'Uniswap V2', 'SushiSwap'"


def _buys(amounts: str) -> str:
    return f"""
        SELECT crisis_id, from_address AS wallet_address, crisis_token AS token_address,
               block_timestamp AS first_buy_timestamp,
               CASE WHEN token0_address = crisis_token THEN amount0 ELSE amount1 END AS total_amount_bought
        FROM {amounts} LEFT JOIN fx_transactions ON transaction_hash = hash
        WHERE from_address IS NOT NULL AND from_address <> '' AND from_address <> '{ZERO_ADDRESS}'
          AND CASE WHEN token0_address = crisis_token THEN amount0 ELSE amount1 END > 0"""


def _priced(buys: str, clipped: bool) -> str:
    seen = "AND p.dt BETWEEN lo AND hi" if clipped else ""
    return f"""
        SELECT crisis_id, wallet_address, token_address, first_buy_timestamp,
               CASE WHEN NOT EXISTS (SELECT 1 FROM fx_prices p WHERE p.token_address = b.token_address {seen}) THEN 1.0
                    WHEN EXISTS (SELECT 1 FROM fx_prices p WHERE p.token_address = b.token_address
                                 AND p.dt <= CAST(first_buy_timestamp AS DATE) {seen})
                    THEN (SELECT arg_max_null(p.price_usd, p.dt) FROM fx_prices p
                          WHERE p.token_address = b.token_address
                            AND p.dt <= CAST(first_buy_timestamp AS DATE) {seen})
                    ELSE (SELECT arg_min_null(p.price_usd, p.dt) FROM fx_prices p
                          WHERE p.token_address = b.token_address {seen})
               END AS first_buy_price,
               total_amount_bought
        FROM {buys} b,
             (SELECT min(CAST(first_buy_timestamp AS DATE)) AS lo, max(CAST(first_buy_timestamp AS DATE)) AS hi
              FROM {buys})"""


def _staged(priced: str) -> str:
    return f"""
        SELECT crisis_id, wallet_address, token_address, first_buy_timestamp, first_buy_price, total_amount_bought,
               total_amount_bought * first_buy_price AS total_usd_spent, CAST(1 AS BIGINT) AS num_transactions
        FROM {priced}"""


STEPS = {
    **{name: oracle_view(name) for name in VIEWS},
    "o_crisis_pools": """
        SELECT DISTINCT pool_address, token0_address, token1_address, dex_protocol, crisis_id,
               c.token_address AS crisis_token, window_start_date, window_end_date, crisis_name
        FROM fx_pools p JOIN fx_events c
          ON p.token0_address = c.token_address OR p.token1_address = c.token_address""",
    "o_swaps": f"""
        SELECT block_timestamp, transaction_hash, log_index, address AS pool_address, data
        FROM fx_logs WHERE topics[1] = '{SWAP_TOPIC}'""",
    "o_windowed": """
        SELECT s.*, token0_address, token1_address, dex_protocol, crisis_id, crisis_token
        FROM o_swaps s JOIN o_crisis_pools p ON s.pool_address = p.pool_address
         AND CAST(block_timestamp AS DATE) >= window_start_date AND CAST(block_timestamp AS DATE) <= window_end_date""",
    "o_abi": _amounts(2, 3, _ONE),
    "o_abi_both": _amounts(2, 3, _TWO),
    "o_shifted": _amounts(1, 2, _ONE),
    "o_shifted_both": _amounts(1, 2, _TWO),
    "o_buys": _buys("o_abi"),
    "o_buys_both": _buys("o_abi_both"),
    "o_buys_shifted": _buys("o_shifted"),
    "o_newest": f"""
        SELECT * FROM o_swaps s SEMI JOIN o_crisis_pools p ON s.pool_address = p.pool_address
        WHERE block_timestamp >= '{SCAN_FROM}' AND block_timestamp <= '{SCAN_UNTIL}'
        ORDER BY block_timestamp DESC, transaction_hash, log_index, pool_address, data LIMIT {LATEST}""",
    "o_newest_abi": _amounts(2, 3, _ONE).replace(
        "o_windowed",
        """(SELECT s.*, token0_address, token1_address, dex_protocol, crisis_id, crisis_token
            FROM o_newest s JOIN o_crisis_pools p ON s.pool_address = p.pool_address
             AND CAST(block_timestamp AS DATE) BETWEEN window_start_date AND window_end_date)"""),
    "o_buys_newest": _buys("o_newest_abi"),
    "o_clipped": _priced("o_buys", True),
    "o_full": _priced("o_buys", False),
    "o_clipped_shifted": _priced("o_buys_shifted", True),
    "o_clipped_newest": _priced("o_buys_newest", True),
    "o_staged": _staged("o_clipped"),
    "o_peaks": """
        SELECT b.*,
               (SELECT max(p.price_usd) FROM fx_prices p WHERE p.token_address = b.token_address
                 AND p.dt > CAST(first_buy_timestamp AS DATE)
                 AND p.dt <= CAST(first_buy_timestamp AS DATE) + 90) AS peak_price,
               (SELECT arg_min(p.dt, (-p.price_usd, p.dt)) FROM fx_prices p WHERE p.token_address = b.token_address
                 AND p.dt > CAST(first_buy_timestamp AS DATE)
                 AND p.dt <= CAST(first_buy_timestamp AS DATE) + 90) AS peak_date
        FROM o_staged b""",
    "o_pnl": """
        SELECT crisis_id, wallet_address, token_address, first_buy_price AS buy_price,
               peak_price AS peak_recovery_price,
               (peak_price - first_buy_price) / first_buy_price * 100 AS estimated_profit_pct,
               (peak_price - first_buy_price) * total_amount_bought AS estimated_profit_usd,
               first_buy_timestamp AS buy_timestamp, CAST(peak_date AS TIMESTAMP) AS peak_recovery_timestamp,
               total_amount_bought AS amount_bought, total_usd_spent AS original_usd_spent
        FROM o_peaks WHERE peak_price IS NOT NULL AND first_buy_price > 0""",
    "o_trades": """
        SELECT * EXCLUDE (amount_bought, original_usd_spent) FROM o_pnl WHERE estimated_profit_pct >= 10""",
    "o_board": """
        SELECT CAST(row_number() OVER (ORDER BY total_profit_usd DESC, wallet_address) AS INTEGER) AS rank, *
        FROM (SELECT wallet_address, round_even(sum(estimated_profit_usd), 2) AS total_profit_usd,
                     round_even(avg(estimated_profit_pct), 2) AS avg_profit_pct, count(*) AS num_trades
              FROM o_trades GROUP BY wallet_address)
        ORDER BY rank LIMIT 10""",
    "o_crisis_symbols": """
        SELECT token_address,
               concat('CRISIS', (SELECT count(DISTINCT e.token_address) FROM fx_events e
                                 WHERE e.token_address <= t.token_address)) AS symbol
        FROM (SELECT DISTINCT token_address FROM fx_events) t""",
    "o_pairs": f"""
        SELECT address, lower(concat('0x', substr(topics[2], 27, 40))) AS token0_address,
               lower(concat('0x', substr(topics[3], 27, 40))) AS token1_address,
               lower(concat('0x', substr(data, 27, 40))) AS pool_address
        FROM fx_factory_logs
        WHERE address = '{PAIR_FACTORY}' AND topics[1] = '{PAIR_CREATED_TOPIC}'""",
    "o_symbol": """
        SELECT n.token_address, coalesce(b.symbol, c.symbol, 'UNK') AS symbol
        FROM (SELECT token0_address AS token_address FROM fx_pools
              UNION SELECT token1_address FROM fx_pools) n
        LEFT JOIN fx_base_tokens b ON n.token_address = b.token_address
        LEFT JOIN o_crisis_symbols c ON n.token_address = c.token_address""",
    "o_offsets": """
        SELECT c.crisis_id, c.token_address, crisis_date, window_start_date, window_end_date,
               b.price_usd AS price_before_crisis, d.price_usd AS price_during_crisis,
               a.price_usd AS price_after_recovery,
               round((d.price_usd - b.price_usd) / b.price_usd * 100, 2) AS crisis_drop_pct,
               round((a.price_usd - d.price_usd) / d.price_usd * 100, 2) AS recovery_gain_pct
        FROM fx_events c
        LEFT JOIN fx_prices b ON c.token_address = b.token_address AND b.dt = crisis_date - 7
        LEFT JOIN fx_prices d ON c.token_address = d.token_address AND d.dt = crisis_date
        LEFT JOIN fx_prices a ON c.token_address = a.token_address AND a.dt = window_end_date + 7""",
    "o_moves": """
        SELECT *, crisis_drop_pct <= -5 AS realistic FROM o_offsets
        WHERE price_before_crisis IS NOT NULL AND price_during_crisis IS NOT NULL
          AND price_after_recovery IS NOT NULL""",
    "o_usage": """
        SELECT p.pool_address, count(l.address) AS transaction_count,
               min(block_timestamp) AS first_seen, max(block_timestamp) AS last_seen
        FROM (SELECT pool_address FROM o_pairs UNION ALL SELECT pool_address FROM fx_quiet_pools) p
        LEFT JOIN fx_logs l ON p.pool_address = l.address
        GROUP BY p.pool_address""",
    "o_returns": """
        SELECT p.token_address, p.dt, (p.price_usd - max(h.price_usd)) / max(h.price_usd) * 100.0 AS return_pct
        FROM fx_prices p JOIN fx_prices h ON p.token_address = h.token_address
         AND h.dt BETWEEN p.dt - 7 AND p.dt - 1
        WHERE p.price_usd > 0 AND h.price_usd > 0
        GROUP BY p.token_address, p.dt, p.price_usd""",
    "o_falls": """
        SELECT r.token_address, r.dt, return_pct, market_return_pct
        FROM o_returns r
        JOIN (SELECT dt, median(return_pct) AS market_return_pct FROM o_returns GROUP BY dt) m ON r.dt = m.dt
        WHERE return_pct <= -20 AND return_pct - market_return_pct <= -15""",
    "o_gained": """
        SELECT wallet_address, count(DISTINCT crisis_id) FILTER (estimated_profit_pct >= 10) AS crises,
               sum(estimated_profit_usd) AS usd
        FROM o_pnl GROUP BY wallet_address""",
    # Every swap of a pool, once for each token of its pair, with what it paid out and took in of that token.
    "o_moved": f"""
        SELECT s.*, token AS crisis_token,
               CASE WHEN token0_address = token THEN CAST({_word(2)} AS DOUBLE) / 1e18
                    ELSE CAST({_word(3)} AS DOUBLE) / 1e18 END AS bought,
               CASE WHEN token0_address = token THEN CAST({_word(0)} AS DOUBLE) / 1e18
                    ELSE CAST({_word(1)} AS DOUBLE) / 1e18 END AS sold
        FROM o_swaps s JOIN fx_pools p ON s.pool_address = p.pool_address AND dex_protocol = 'Uniswap V2',
             LATERAL (SELECT token0_address AS token UNION SELECT token1_address) t""",
    "o_struck": """
        SELECT coalesce(r.token_address, d.token_address) AS token_address, coalesce(r.dt, d.dt) AS dt,
               return_pct, market_return_pct, drain_pct
        FROM (SELECT r.*, market_return_pct FROM o_returns r
              JOIN (SELECT dt, median(return_pct) AS market_return_pct FROM o_returns GROUP BY dt) m ON r.dt = m.dt) r
        FULL JOIN (SELECT p.token_address, p.dt, (p.liquidity_usd - max(h.liquidity_usd)) / max(h.liquidity_usd) * 100.0 AS drain_pct
                   FROM fx_prices p LEFT JOIN fx_prices h ON p.token_address = h.token_address
                    AND h.dt BETWEEN p.dt - 7 AND p.dt - 1
                   GROUP BY p.token_address, p.dt, p.liquidity_usd) d
          ON r.token_address = d.token_address AND r.dt = d.dt
        WHERE (return_pct <= -20 AND return_pct - market_return_pct <= -15) OR drain_pct <= -60""",
    "o_crashes": """
        SELECT r.token_address, r.dt
        FROM o_returns r
        JOIN (SELECT dt, median(return_pct) AS market_return_pct FROM o_returns GROUP BY dt) m ON r.dt = m.dt
        WHERE return_pct <= -50 AND return_pct - market_return_pct <= -40""",
    "o_detected": """
        SELECT concat('crisis_', lpad(CAST(row_number() OVER (ORDER BY dt, token_address) AS VARCHAR),
                      CAST(greatest(3, length(CAST(row_number() OVER (ORDER BY dt, token_address) AS VARCHAR))) AS INTEGER), '0'))
                 AS crisis_id,
               token_address, dt AS crisis_date
        FROM o_crashes f
        WHERE NOT EXISTS (SELECT 1 FROM o_crashes y WHERE y.token_address = f.token_address AND y.dt = f.dt - 1)""",
    "o_traded": f"""
        SELECT from_address AS wallet_address, crisis_token AS token_address, block_timestamp AS traded_at,
               transaction_hash, log_index, pool_address,
               CASE WHEN EXISTS (SELECT 1 FROM fx_events e WHERE e.token_address = crisis_token
                    AND CAST(block_timestamp AS DATE) BETWEEN window_start_date AND window_end_date)
                    THEN bought ELSE 0 END AS bought, sold
        FROM o_moved JOIN fx_transactions ON transaction_hash = hash
        WHERE from_address NOT IN ('', '{ZERO_ADDRESS}')
          AND EXISTS (SELECT 1 FROM fx_events e WHERE e.token_address = crisis_token
              AND CAST(block_timestamp AS DATE) BETWEEN window_start_date AND window_end_date + 90)""",
    "o_valued": """
        SELECT t.*, coalesce((SELECT arg_max(p.price_usd, p.dt) FROM fx_prices p
                              WHERE p.token_address = t.token_address AND p.dt <= CAST(traded_at AS DATE)),
                             (SELECT arg_min(p.price_usd, p.dt) FROM fx_prices p
                              WHERE p.token_address = t.token_address), 1.0) AS price
        FROM o_traded t WHERE bought > 0 OR sold > 0""",
    "o_ordered": """
        SELECT *, row_number() OVER (PARTITION BY wallet_address, token_address
                                     ORDER BY traded_at, sold > 0, transaction_hash, log_index, pool_address) AS n
        FROM o_valued""",
    # One trade after the other: what is held, what all buys so far cost, and what a sale closes of it.
    "o_walk": """
        SELECT wallet_address, token_address, n, CAST(NULL AS DATE) AS last_buy, 0.0::DOUBLE AS held, 0.0::DOUBLE AS amount,
               0.0::DOUBLE AS cost, 0.0::DOUBLE AS sales, 0.0::DOUBLE AS closed, 0.0::DOUBLE AS profit
        FROM (SELECT DISTINCT wallet_address, token_address, 0 AS n FROM o_ordered)
        UNION ALL
        SELECT o.wallet_address, o.token_address, o.n,
               CASE WHEN o.bought > 0 THEN CAST(traded_at AS DATE) ELSE last_buy END,
               held + o.bought - least(CASE WHEN CAST(traded_at AS DATE) - last_buy <= 90 THEN o.sold ELSE 0 END, held),
               amount + o.bought, cost + o.bought * price,
               sales + CASE WHEN CAST(traded_at AS DATE) - last_buy <= 90 THEN o.sold ELSE 0 END,
               closed + least(CASE WHEN CAST(traded_at AS DATE) - last_buy <= 90 THEN o.sold ELSE 0 END, held),
               profit + CASE WHEN amount > 0 AND o.sold > 0 AND CAST(traded_at AS DATE) - last_buy <= 90
                             THEN least(o.sold, held) * (price - cost / amount) ELSE 0 END
        FROM o_walk w JOIN o_ordered o
          ON o.wallet_address = w.wallet_address AND o.token_address = w.token_address AND o.n = w.n + 1""",
}

# The same trades where only the hours 12 to 84 after the start of the crisis day count as buys.
for _step in ("o_traded", "o_valued", "o_ordered", "o_walk"):
    STEPS[f"{_step}_hours"] = re.sub(r"\bo_(traded|valued|ordered|walk)\b", r"o_\1_hours", STEPS[_step])
STEPS["o_traded_hours"] = STEPS["o_traded_hours"].replace(
    "CAST(block_timestamp AS DATE) BETWEEN window_start_date AND window_end_date)",
    "block_timestamp BETWEEN CAST(crisis_date AS TIMESTAMP) + INTERVAL 12 HOUR AND CAST(crisis_date AS TIMESTAMP) + INTERVAL 84 HOUR)"
).replace("window_start_date AND window_end_date + 90", "crisis_date AND crisis_date + 93")

_PRICED = (
    "crisis_id, wallet_address, token_address, first_buy_timestamp, first_buy_price, total_amount_bought"
)
_LOGS = "block_timestamp, transaction_hash, log_index, pool_address, data"
_DECODED = """
    SELECT crisis_id, transaction_hash, log_index, pool_address, amount0, amount1,
           CASE WHEN dex_protocol <> 'Uniswap V2' THEN NULL
                WHEN token0_address = crisis_token THEN amount0 ELSE amount1 END AS bought_amount
    FROM """


def _violations(rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{rule}' AS rule, '{column}' AS "column", CAST({count} AS BIGINT) AS violations"""
        + (" FROM fx_broken_buys" if "(" in count else "")
        for rule, column, count in rules
    )


def _null_count(column: str) -> str:
    return f"count(*) FILTER ({column} IS NULL)"


def _negative_count(column: str) -> str:
    return f"count(*) FILTER ({column} < 0)"


SELECTS = {
    "scan_crisis_events":
        "SELECT crisis_id, token_address, window_start_date, window_end_date, crisis_name FROM fx_events",
    "scan_pool_names": "SELECT pool_address, pool_name, dex_protocol FROM fx_pools",
    "scan_price_history": """
        SELECT token_address, dt, price_usd FROM fx_prices
        WHERE token_address IN (SELECT token_address FROM fx_events)
          AND dt BETWEEN (SELECT min(window_start_date) FROM fx_events) AND (SELECT max(window_end_date) FROM fx_events)""",
    "scan_factory_logs": f"""
        SELECT block_timestamp, address, data FROM fx_factory_logs
        WHERE address = '{PAIR_FACTORY}' AND topics[1] = '{PAIR_CREATED_TOPIC}'""",
    "scan_swap_logs": f"""
        SELECT {_LOGS} FROM o_swaps
        WHERE block_timestamp >= '{SCAN_FROM}' AND block_timestamp <= '{SCAN_UNTIL}'
          AND pool_address IN (SELECT pool_address FROM o_crisis_pools)""",
    "latest_swaps_topn": f"""
        SELECT {_LOGS} FROM o_swaps
        ORDER BY block_timestamp DESC, transaction_hash, log_index, pool_address, data LIMIT {LATEST}""",
    "crisis_pools": "SELECT * FROM o_crisis_pools",
    "swap_sender_join": f"""
        SELECT block_timestamp, transaction_hash, log_index, pool_address, from_address AS wallet_address
        FROM o_swaps LEFT JOIN fx_transactions ON transaction_hash = hash
        WHERE from_address IS NOT NULL AND from_address NOT IN ('', '{ZERO_ADDRESS}')""",
    "swaps_in_window": f"""
        SELECT crisis_id, crisis_token, token0_address, token1_address, dex_protocol, {_LOGS} FROM o_windowed""",
    "decode_amounts_abi": _DECODED + "o_abi_both",
    "decode_amounts_shifted": _DECODED + "o_shifted_both",
    "crisis_buys": "SELECT * FROM o_buys",
    "multi_protocol_buys": "SELECT * FROM o_buys_both",
    "asof_price_clipped": f"SELECT {_PRICED} FROM o_clipped",
    "asof_price_full": f"SELECT {_PRICED} FROM o_full",
    "stage_buys": "SELECT * FROM o_staged",
    "stage_buys_shifted": _staged("o_clipped_shifted"),
    "stage_buys_latest": _staged("o_clipped_newest"),
    "write_roundtrip": "SELECT * FROM o_staged",
    "peak_after_buy": """
        SELECT crisis_id, wallet_address, token_address, first_buy_timestamp, peak_price, peak_date
        FROM o_peaks WHERE peak_price IS NOT NULL""",
    "estimated_pnl": "SELECT * FROM o_pnl",
    "profitable_trades": "SELECT * FROM o_trades",
    "wallet_leaderboard": "SELECT * FROM o_board",
    "leaderboard_trades": """
        SELECT b.rank, t.wallet_address,
               CAST(row_number() OVER (PARTITION BY t.wallet_address
                    ORDER BY estimated_profit_pct DESC, buy_timestamp, crisis_id, token_address, estimated_profit_usd)
                    AS INTEGER) AS trade_no,
               crisis_id, token_address, buy_price, peak_recovery_price, estimated_profit_pct, estimated_profit_usd
        FROM o_trades t JOIN o_board b ON t.wallet_address = b.wallet_address""",
    "top_multiples": """
        SELECT CAST(row_number() OVER (ORDER BY total_profit_usd DESC, wallet_address) AS INTEGER) AS rank, *
        FROM (SELECT wallet_address, round_even(sum(estimated_profit_usd), 2) AS total_profit_usd,
                     round_even(avg(estimated_profit_pct), 2) AS avg_profit_pct, count(*) AS num_trades
              FROM o_pnl WHERE peak_recovery_price / buy_price > 3 GROUP BY wallet_address)
        ORDER BY rank LIMIT 100""",
    "pnl_summary": """
        SELECT least(count(DISTINCT wallet_address), 10) AS listed_wallets, count(*) AS trades,
               round(sum(estimated_profit_usd), 2) AS total_profit_usd,
               round(avg(estimated_profit_pct), 2) AS avg_profit_pct
        FROM o_trades""",
    "profit_kept_ratio": """
        SELECT count(*) AS estimated_trades, count(*) FILTER (estimated_profit_pct >= 10) AS kept_trades,
               round(count(*) FILTER (estimated_profit_pct >= 10) / count(*), 6) AS kept_ratio,
               round(avg(estimated_profit_pct), 2) AS avg_profit_pct
        FROM o_pnl""",
    "build_pools": """
        SELECT pool_address, concat(s0.symbol, '-', s1.symbol, ' Pool') AS pool_name,
               token0_address, s0.symbol AS token0_symbol, token1_address, s1.symbol AS token1_symbol,
               'Uniswap V2' AS dex_protocol, 'ethereum' AS chain
        FROM o_pairs
        JOIN o_symbol s0 ON token0_address = s0.token_address
        JOIN o_symbol s1 ON token1_address = s1.token_address
        WHERE (token0_address IN (SELECT token_address FROM fx_events)
               AND token1_address IN (SELECT token_address FROM fx_base_tokens))
           OR (token0_address IN (SELECT token_address FROM fx_base_tokens)
               AND token1_address IN (SELECT token_address FROM fx_events))""",
    "token_symbols": """
        SELECT pool_address, s0.symbol AS token0_symbol, s1.symbol AS token1_symbol
        FROM fx_pools JOIN o_symbol s0 ON token0_address = s0.token_address
        JOIN o_symbol s1 ON token1_address = s1.token_address""",
    "sql_udf_decode": f"""
        SELECT lower(concat('0x', substr(topics[2], 27, 40))) AS token0_address,
               lower(concat('0x', substr(topics[3], 27, 40))) AS token1_address,
               CAST(NULL AS VARCHAR) AS missing_address,
               lower(concat('0x', substr(data, 27, 40))) AS pool_address,
               address = '{PAIR_FACTORY}' AS known_factory,
               CASE WHEN address = '{PAIR_FACTORY}' THEN 'Uniswap V2' ELSE 'Unknown' END AS dex_protocol
        FROM fx_factory_logs""",
    "price_at_offsets": "SELECT * FROM o_offsets",
    "crisis_move_check": "SELECT * FROM o_moves",
    "crisis_move_summary": """
        SELECT count(*) AS crises, count(*) FILTER (NOT realistic) AS unrealistic,
               count(*) > 0 AND count(*) FILTER (NOT realistic) = 0 AS passed
        FROM o_moves""",
    "pool_activity": """
        SELECT address AS pool_address, count(*) AS transaction_count,
               min(block_timestamp) AS first_seen, max(block_timestamp) AS last_seen
        FROM fx_logs WHERE block_timestamp >= '1999-01-01' AND address IN (SELECT pool_address FROM fx_pools)
        GROUP BY address""",
    "pool_activity_all": """
        SELECT address AS pool_address, count(*) AS transaction_count,
               min(block_timestamp) AS first_seen, max(block_timestamp) AS last_seen
        FROM fx_logs WHERE address IN (SELECT pool_address FROM fx_pools)
        GROUP BY address""",
    "pool_usage": "SELECT * FROM o_usage",
    "pool_coverage": """
        SELECT count(*) AS pools, count(*) FILTER (transaction_count > 0) AS real_pools,
               count(*) FILTER (transaction_count = 0) AS mock_pools,
               round(count(*) FILTER (transaction_count > 0) / count(*) * 100, 1) AS real_pct,
               round(count(*) FILTER (transaction_count = 0) / count(*) * 100, 1) AS mock_pct,
               count(*) FILTER (transaction_count > 0) > 0 AS passed
        FROM o_usage""",
    "table_completeness": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) > 0 AS passed FROM {t}" for t in TEST_TABLES
    ),
    "distinct_counts": """
        SELECT count(*) AS row_count, count(DISTINCT l_orderkey) AS distinct_l_orderkey,
               count(DISTINCT l_suppkey) AS distinct_l_suppkey, count(DISTINCT l_shipdate) AS distinct_l_shipdate
        FROM lineitem""",
    "distinct_counts_sketched": """
        SELECT count(*) AS row_count, count(*) AS days_rows, count(DISTINCT l_orderkey) AS distinct_l_orderkey,
               count(DISTINCT l_suppkey) AS distinct_l_suppkey, count(DISTINCT l_partkey) AS distinct_l_partkey,
               true AS close_l_orderkey, true AS close_l_suppkey, true AS close_l_partkey
        FROM lineitem""",
    "sample_crises": "SELECT * FROM fx_events ORDER BY md5(concat('7:', crisis_id)) LIMIT 2",
    "daily_median_move": "SELECT dt, round(median(price_usd), 6) AS median FROM fx_prices GROUP BY dt",
    "validate_buys": _violations([
        ("present", "crisis_id", "0"), ("not_null", "crisis_id", _null_count("crisis_id")),
        ("present", "wallet_address", "0"), ("not_null", "wallet_address", _null_count("wallet_address")),
        ("present", "token_address", "0"), ("not_null", "token_address", _null_count("token_address")),
        ("present", "first_buy_timestamp", "0"),
        ("not_null", "first_buy_timestamp", _null_count("first_buy_timestamp")), ("type", "first_buy_timestamp", "0"),
        ("present", "first_buy_price", "0"), ("type", "first_buy_price", "0"),
        ("not_negative", "first_buy_price", _negative_count("first_buy_price")),
        ("present", "total_amount_bought", "0"), ("type", "total_amount_bought", "0"),
        ("not_negative", "total_amount_bought", _negative_count("total_amount_bought")),
        ("present", "total_usd_spent", "0"), ("type", "total_usd_spent", "0"),
        ("not_negative", "total_usd_spent", _negative_count("total_usd_spent")),
        ("present", "num_transactions", "0"), ("type", "num_transactions", "0"),
        ("exactly_one", "num_transactions", "count(*) FILTER (num_transactions IS DISTINCT FROM 1)"),
    ]),
    "buy_windows": """
        SELECT concat('crisis_', lpad(CAST(row_number() OVER (ORDER BY crisis_date, token_address) AS VARCHAR), 3, '0'))
                 AS crisis_id,
               token_address, crisis_date, crisis_name, crisis_date AS window_start_date,
               crisis_date + CAST(length(crisis_name) AS INTEGER) AS window_end_date, crisis_date AS dt
        FROM fx_events""",
    "first_crisis_order": """
        SELECT token_address, min(crisis_date) AS first_crisis_date,
               CAST(row_number() OVER (ORDER BY min(crisis_date), token_address) AS INTEGER) AS position
        FROM fx_events GROUP BY token_address""",
    "crisis_phase": """
        SELECT p.token_address, p.dt,
               coalesce(
                 (SELECT arg_max(CASE WHEN e.crisis_date - p.dt >= 0 THEN 'drop' ELSE 'recovery' END,
                                 (e.crisis_date, e.crisis_id))
                  FROM fx_events e WHERE e.token_address = p.token_address
                   AND e.crisis_date - p.dt BETWEEN -7 AND 3),
                 CASE WHEN EXISTS (SELECT 1 FROM fx_events e WHERE e.token_address = p.token_address
                                   AND abs(e.crisis_date - p.dt) <= 7) THEN 'near' END,
                 'normal') AS phase
        FROM fx_prices p""",
    "detect_crises": """
        SELECT token_address, dt AS crisis_date, round(return_pct, 6) AS return_pct,
               round(market_return_pct, 6) AS market_return_pct
        FROM o_falls f
        WHERE NOT EXISTS (SELECT 1 FROM o_falls y WHERE y.token_address = f.token_address AND y.dt = f.dt - 1)""",
    "word_topk": """
        SELECT lower(word) AS word, word_count, corpus
        FROM (SELECT word, corpus, count(*) AS word_count
              FROM (SELECT unnest(string_split(text, ' ')) AS word, source AS corpus FROM documents)
              WHERE word <> '' GROUP BY word, corpus HAVING count(*) > 100
              ORDER BY word_count DESC, word, corpus LIMIT 10)""",
    "buyer_rollup": """
        SELECT crisis_id, wallet_address, token_address, min(first_buy_timestamp) AS first_buy_timestamp,
               arg_min(first_buy_price, (first_buy_timestamp, first_buy_price)) AS first_buy_price,
               round(sum(total_amount_bought), 6) AS total_amount_bought,
               round(sum(total_usd_spent), 2) AS total_usd_spent, count(*) AS num_transactions,
               round(sum(total_usd_spent) / sum(total_amount_bought), 6) AS avg_buy_price
        FROM o_staged GROUP BY crisis_id, wallet_address, token_address""",
    "wallet_labels": """
        SELECT wallet_address,
               CASE WHEN coalesce(max(crises), 0) >= 2 AND max(crises) / count(DISTINCT crisis_id) >= 0.75 THEN 'elite'
                    WHEN coalesce(max(crises), 0) >= 1 THEN 'profitable' ELSE 'participant' END AS label_value,
               count(DISTINCT crisis_id) AS num_crisis_events,
               coalesce(max(crises), 0) AS total_profited_crises,
               round(coalesce(max(crises), 0) / count(DISTINCT crisis_id), 2) AS success_rate,
               round(coalesce(max(usd), 0) / sum(total_usd_spent) * 100, 2) AS total_pnl_pct,
               round(coalesce(max(usd), 0), 2) AS total_pnl_usdt
        FROM o_staged LEFT JOIN o_gained USING (wallet_address) GROUP BY wallet_address""",
    "buys_after_crash": """
        SELECT crisis_id, from_address AS wallet_address, crisis_token AS token_address,
               block_timestamp AS first_buy_timestamp, bought AS total_amount_bought
        FROM o_moved JOIN fx_transactions ON transaction_hash = hash
        JOIN fx_events e ON e.token_address = crisis_token
         AND block_timestamp BETWEEN CAST(crisis_date AS TIMESTAMP) + INTERVAL 12 HOUR
                                 AND CAST(crisis_date AS TIMESTAMP) + INTERVAL 84 HOUR
        WHERE bought > 0 AND from_address NOT IN ('', '{ZERO_ADDRESS}')""".replace("{ZERO_ADDRESS}", ZERO_ADDRESS),
    "detect_crises_drain": """
        SELECT token_address, dt AS crisis_date, round(return_pct, 6) AS return_pct,
               round(market_return_pct, 6) AS market_return_pct, round(drain_pct, 6) AS drain_pct
        FROM o_struck f
        WHERE NOT EXISTS (SELECT 1 FROM o_struck y WHERE y.token_address = f.token_address AND y.dt = f.dt - 1)""",
    "detected_crisis_buys": f"""
        SELECT crisis_id, from_address AS wallet_address, crisis_token AS token_address,
               block_timestamp AS first_buy_timestamp, bought AS total_amount_bought
        FROM o_moved JOIN fx_transactions ON transaction_hash = hash
        JOIN o_detected d ON d.token_address = crisis_token
         AND CAST(block_timestamp AS DATE) BETWEEN crisis_date AND crisis_date + 10
        WHERE bought > 0 AND from_address NOT IN ('', '{ZERO_ADDRESS}')""",
    "realised_profit": """
        SELECT wallet_address, token_address, round(arg_max(amount, n), 3) AS bought_amount,
               round(arg_max(sales, n), 3) AS sold_amount, round(arg_max(closed, n), 3) AS closed_amount,
               round(arg_max(profit, n), 2) AS realised_profit_usd
        FROM o_walk GROUP BY wallet_address, token_address HAVING arg_max(closed, n) > 0""",
}

def _safe_word(index: int) -> str:
    digits = f"substr(data, {3 + 64 * index}, 64)"
    return f"CASE WHEN regexp_full_match({digits}, '[0-9a-fA-F]{{64}}') THEN CAST(CAST(concat('0x', {digits}) AS UHUGEINT) AS DOUBLE) / 1e18 END"


SELECTS |= {
    "broken_payloads": f"""
        SELECT transaction_hash, log_index, pool_address, {_safe_word(2)} AS amount0, {_safe_word(3)} AS amount1
        FROM fx_broken_logs JOIN fx_pools ON lower(address) = pool_address WHERE topics[1] = '{SWAP_TOPIC}'""",
    "format_broken_buys": """
        SELECT crisis_id, wallet_address, token_address, first_buy_timestamp, TRY_CAST(first_buy_price AS DOUBLE) AS first_buy_price,
               total_amount_bought, total_usd_spent, CAST(1 AS BIGINT) AS num_transactions
        FROM fx_priced
        WHERE crisis_id NOT IN ('', 'nan') AND wallet_address NOT IN ('', 'nan') AND token_address NOT IN ('', 'nan')
          AND first_buy_timestamp IS NOT NULL""",
    "broken_pairs": """
        SELECT 'Uniswap V2' AS dex_protocol, lower(concat('0x', substr(topics[2], 27, 40))) AS token0_address,
               lower(concat('0x', substr(topics[3], 27, 40))) AS token1_address,
               lower(concat('0x', substr(data, 27, 40))) AS pool_address
        FROM fx_broken_pairs WHERE length(data) >= 66 AND length(topics[2]) = 66 AND length(topics[3]) = 66""",
    "catalog_tables": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {t != 'dim_token_price_history'} AS kept, "
        + {"crisis_events_with_window": "(SELECT count(*) FROM fx_events)", "dim_token_price_history": "CAST(NULL AS BIGINT)"}.get(t, "CAST(0 AS BIGINT)")
        + " AS row_count" for t in TABLES),
    "newest_buys": """
        SELECT crisis_id, first_buy_timestamp FROM o_staged ORDER BY crisis_id, first_buy_timestamp DESC LIMIT 10""",
    "best_trades": "SELECT round(estimated_profit_pct, 6) AS estimated_profit_pct FROM o_trades ORDER BY 1 DESC LIMIT 10",
}
SELECTS["swap_sender_join_stored"] = SELECTS["swap_sender_join"]
SELECTS["asof_price_stored"] = SELECTS["asof_price_full"]
SELECTS["realised_profit_sliced"] = SELECTS["realised_profit"]
SELECTS["realised_profit_hours"] = SELECTS["realised_profit"].replace("o_walk", "o_walk_hours")


def _needed(text: str, found: set[str]) -> set[str]:
    for name in set(re.findall(r"\b(?:fx|o)_\w+", text)) & STEPS.keys() - found:
        found.add(name)
        _needed(STEPS[name], found)
    return found


def oracle(name: str) -> str:
    """The full text of one query: the steps it needs, in the order of their declaration, and its select."""
    used = _needed(SELECTS[name], set())
    steps = ",\n".join(f"{step} AS ({STEPS[step]})" for step in STEPS if step in used)
    return f"WITH RECURSIVE {steps}\n{SELECTS[name]}" if steps else SELECTS[name]


ORACLES = {name: oracle(name) for name in SELECTS}
