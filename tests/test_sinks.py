import logging
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from helpers import BUYS, EVENTS, LOGS, PRICES, TRANSACTIONS, UNIT, address, at, buy, day, event, pair_created, payload, rows, swap
from slumptrace import schemas
from slumptrace.operators import quality
from slumptrace.plans import jobs
from slumptrace.plans.stage_one import StageOneOptions
from slumptrace.plans.stage_two import StageTwoOptions
from slumptrace.sources import catalog, readers, sinks


@pytest.fixture
def database(spark):
    name = f"db_{uuid4().hex}"
    catalog.ensure_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def content(spark, database, table):
    return rows(spark.table(f"{database}.{table.name}"))


def test_tables_are_created_once_and_dropped_on_request(spark, database):
    assert catalog.ensure_tables(spark, database) == sorted(schemas.TABLES)
    spark.createDataFrame([buy("w", "2022-01-01", 1.0, 1.0)], BUYS).write.insertInto(f"{database}.stg_crisis_buyers")
    catalog.ensure_tables(spark, database)
    assert spark.table(f"{database}.stg_crisis_buyers").count() == 1
    catalog.ensure_tables(spark, database, [schemas.STAGED_BUYS], drop=True)
    assert spark.table(f"{database}.stg_crisis_buyers").count() == 0


@pytest.mark.parametrize("table", schemas.TABLES.values(), ids=lambda t: t.name)
def test_declared_columns_comments_and_partitions(spark, database, table):
    catalog.ensure_tables(spark, database, [table])
    described = spark.catalog.listColumns(f"{database}.{table.name}")
    assert [(c.name, c.dataType, c.description) for c in described] == [
        (f.name, f.dataType.simpleString(), f.metadata["comment"]) for f in table.schema]
    assert [c.name for c in described if c.isPartition] == list(table.partition_by)
    assert spark.catalog.getTable(f"{database}.{table.name}").description == table.comment
    assert catalog.empty(spark, table).columns == table.schema.names


def test_write_replaces_the_whole_table_and_keeps_its_declaration(spark, frame, database):
    first = frame(PRICES, ("a", 1.0, day("2022-01-01")), ("a", 2.0, day("2022-01-02")))
    assert sinks.write_table(first, database, schemas.PRICES, fill_missing=True) == 2
    second = frame("dt date, token_address string, price_usd int", (day("2022-01-03"), "b", 3))
    assert sinks.write_table(second, database, schemas.PRICES, fill_missing=True) == 1
    assert rows(spark.table(f"{database}.dim_token_price_history"), "token_address", "price_usd", "volume_24h_usd", "dt") == [
        ("b", 3.0, None, day("2022-01-03"))]
    assert spark.catalog.getTable(f"{database}.dim_token_price_history").description == schemas.PRICES.comment


def test_a_table_may_be_rewritten_from_itself(spark, frame, database):
    sinks.write_table(frame(BUYS, buy("w", "2022-01-01", 1.0, 1.0)), database, schemas.STAGED_BUYS)
    own = spark.table(f"{database}.stg_crisis_buyers")
    sinks.write_table(own.union(own), database, schemas.STAGED_BUYS)
    assert spark.table(f"{database}.stg_crisis_buyers").count() == 2


def test_nothing_is_written_when_a_check_fails_or_on_a_dry_run(spark, frame, database, caplog):
    kept = frame(BUYS, buy("kept", "2022-01-01", 1.0, 1.0))
    sinks.write_table(kept, database, schemas.STAGED_BUYS)
    seen = []
    good = frame(BUYS, buy("new", "2022-01-01", 1.0, 1.0))
    assert sinks.write_table(good, database, schemas.STAGED_BUYS, dry_run=True, validate=quality.require_valid,
                             sample=lambda df: seen.append(df.limit(10).count())) == 1
    assert seen == [1]
    with pytest.raises(ValueError, match="not_negative"):
        sinks.write_table(frame(BUYS, buy("bad", "2022-01-01", -1.0, 1.0)), database, schemas.STAGED_BUYS,
                          validate=quality.require_valid)
    with pytest.raises(ValueError, match="nulls in required columns"):
        sinks.write_table(frame(BUYS, buy(None, "2022-01-01", 1.0, 1.0)), database, schemas.STAGED_BUYS)
    with caplog.at_level(logging.WARNING):
        assert sinks.write_table(good.limit(0), database, schemas.STAGED_BUYS) == 0
    assert "no rows" in caplog.text
    with pytest.raises(ValueError, match="no rows"):
        sinks.write_table(good.limit(0), database, schemas.STAGED_BUYS, on_empty="error")
    assert rows(spark.table(f"{database}.stg_crisis_buyers"), "wallet_address") == [("kept",)]


def test_a_write_that_fails_midway_leaves_the_old_rows(spark, frame, database, monkeypatch):
    """The switch comes last: until then, and after a failure, the old version is the table."""
    import os

    old = frame(PRICES, ("A", 1.0, day("2022-01-01")), ("b", 2.0, day("2022-01-02")))
    sinks.write_table(old, database, schemas.PRICES, fill_missing=True)
    place = catalog.location(spark, database, schemas.PRICES.name)
    new = frame(PRICES, *[("c", float(k), day(f"2022-02-{k:02}")) for k in range(1, 20)])
    monkeypatch.setattr(sinks, "laid_out", lambda df, table: df.repartition(4).withColumn(
        "price_usd", F.when(F.col("price_usd") == 7.0, F.raise_error(F.lit("lost"))).otherwise(F.col("price_usd")).cast("double")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_table(new, database, schemas.PRICES, fill_missing=True)
    assert rows(spark.table(f"{database}.dim_token_price_history"), "token_address", "price_usd") == [("a", 1.0), ("b", 2.0)]
    monkeypatch.undo()
    assert catalog.list_tables(spark, database) == [schemas.PRICES.name]
    sinks.write_table(new, database, schemas.PRICES, fill_missing=True)
    assert spark.table(f"{database}.dim_token_price_history").count() == 19
    now = catalog.location(spark, database, schemas.PRICES.name)
    folder = now.replace("file:", "")
    assert now != place and not os.path.exists(place.replace("file:", "")) and os.listdir(os.path.dirname(folder)) == [os.path.basename(folder)]
    assert catalog.list_tables(spark, database) == [schemas.PRICES.name]
    catalog.ensure_tables(spark, database, [schemas.PRICES], drop=True)
    assert spark.table(f"{database}.dim_token_price_history").count() == 0


def test_declared_buckets(spark, frame, database):
    catalog.ensure_tables(spark, database, [schemas.PRICES])
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {database}.dim_token_price_history").collect()}
    assert (described["Num Buckets"], described["Bucket Columns"], described["Sort Columns"]) == (
        "16", "[`token_address`]", "[`token_address`, `dt`]")
    assert not catalog.is_normalised(spark, database, schemas.PRICES.name)


def test_stored_prices_are_not_shuffled(spark, frame, database, monkeypatch):
    from slumptrace.operators import pricing

    quotes = [(t, float(k), day(f"2022-01-{k:02}")) for t in ("A", "b", "c") for k in range(1, 29)]
    sinks.write_table(frame(PRICES, *quotes), database, schemas.PRICES, fill_missing=True)
    history = readers.load_table(spark, database, schemas.PRICES)
    buys = frame(BUYS, *[buy("w", f"2022-01-{k:02} 10:00:00", None, 1.0, token=t) for t in ("a", "c", "z") for k in (3, 9, 30)])
    days = pricing.buy_days(buys)
    for found, plain in ((pricing.asof_prices(history, days), pricing.asof_prices(frame(PRICES, *quotes), days)),
                         (pricing.peak_prices(history, days, 5), pricing.peak_prices(frame(PRICES, *quotes), days, 5))):
        plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
        scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "price_usd" in line)
        assert "Bucketed: true" in plan[scan]
        union = max(i for i, line in enumerate(plan[:scan]) if "Union" in line)
        # Nothing moves above the union, nor between it and the prices.
        moved = [line for line in plan[:scan] if "Exchange" in line and "Broadcast" not in line]
        assert not moved, "\n".join(plan[:union + 1])
        assert rows(found) == rows(plain)


@pytest.mark.parametrize("broken, message", [
    (lambda df: df.drop("total_usd_spent"), "total_usd_spent is missing"),
    (lambda df: df.withColumn("first_buy_price", F.lit("1.5")), "first_buy_price is string"),
    (lambda df: df.withColumn("first_buy_timestamp", F.lit(1)), "first_buy_timestamp is int"),
])
def test_missing_and_wrongly_typed_columns_fail(spark, frame, database, broken, message):
    sinks.write_table(frame(BUYS, buy("kept", "2022-01-01", 1.0, 1.0)), database, schemas.STAGED_BUYS)
    with pytest.raises(ValueError, match=message):
        sinks.write_table(broken(frame(BUYS, buy("new", "2022-01-01", 1.0, 1.0))), database, schemas.STAGED_BUYS,
                          validate=quality.require_valid)
    assert rows(spark.table(f"{database}.stg_crisis_buyers"), "wallet_address") == [("kept",)]


def test_finding_crises_fills_their_table(spark, frame, database):
    with pytest.raises(ValueError, match="no price history"):
        jobs.find_crises(spark, database) if catalog.ensure_tables(spark, database) else None
    series = {"a": (100, 100, 60, 55, 90, 90), "b": (100, 100, 99, 99, 98, 98), "c": (100, 100, 98, 97, 97, 97)}
    liquid = {"a": (9, 9, 9, 9, 9, 9), "b": (100, 100, 100, 100, 30, 30), "c": (5, 5, 5, 5, 5, None)}
    history = [(t, float(p), None if q is None else float(q), day(f"2022-01-0{k + 1}"))
               for t in series for k, (p, q) in enumerate(zip(series[t], liquid[t], strict=True))]
    prices = frame("token_address string, price_usd double, liquidity_usd double, dt date", *history)
    sinks.write_table(prices, database, schemas.PRICES, fill_missing=True)
    before = set(staged_folders(spark))
    assert jobs.find_crises(spark, database, window_days=5) == 2
    assert set(staged_folders(spark)) == before
    assert rows(spark.table(f"{database}.crisis_events_with_window"), "crisis_id", "token_address", "window_start_date", "window_end_date") == [
        ("crisis_001", "a", day("2022-01-03"), day("2022-01-08")), ("crisis_002", "b", day("2022-01-05"), day("2022-01-10"))]


def staged_folders(spark):
    import os

    folder = spark.conf.get("spark.checkpoint.dir").replace("file:", "")
    return os.listdir(folder) if os.path.isdir(folder) else []


def test_whole_run(spark, frame, database, tmp_path):
    token, base, pool = 0x10, 0xB0, 0xF0
    catalog.ensure_tables(spark, database)
    with pytest.raises(ValueError, match="no crisis events"):
        jobs.prepare_pools(spark, database, str(tmp_path / "logs"))
    sinks.write_table(frame(EVENTS, event("c1", address(token), "2022-01-10", "2022-01-12")), database, schemas.CRISIS_EVENTS)
    sinks.write_table(frame(PRICES, *[(address(token), p, day(d)) for p, d in (
        (10.0, "2022-01-03"), (5.0, "2022-01-10"), (9.0, "2022-01-19"), (20.0, "2022-02-01"))]), database, schemas.PRICES, fill_missing=True)
    frame(LOGS, pair_created(token, base, pool), *[
        swap(f"2022-01-1{d} 10:00:00", f"t{d}", address(pool), payload(0, UNIT, d * UNIT, 0)) for d in range(1, 4)
    ]).write.parquet(str(tmp_path / "logs"))
    frame(TRANSACTIONS, ("t1", "w1"), ("t2", "w2")).write.parquet(str(tmp_path / "tx"))
    logs, tx = str(tmp_path / "logs"), str(tmp_path / "tx")

    before = set(staged_folders(spark))
    assert jobs.prepare_pools(spark, database, logs, {address(base): "BASE"}) == 1
    report = jobs.verify(spark, database, logs)
    assert report.passed and rows(report.coverage, "pools") == [(1,)]
    assert set(staged_folders(spark)) == before
    assert rows(report.moves, "crisis_drop_pct", "recovery_gain_pct") == [(-50.0, 80.0)]

    options = StageOneOptions(clip_history=False)
    assert jobs.stage_one(spark, database, logs, tx, options, dry_run=True) == 2
    with pytest.raises(ValueError, match="no crisis buyers"):
        jobs.stage_two(spark, database)
    before = set(staged_folders(spark))
    assert jobs.stage_one(spark, database, logs, tx, options) == 2
    assert set(staged_folders(spark)) == before  # a finished job leaves no intermediate table
    assert jobs.realise(spark, database, logs, tx, options) == 0
    outcome = jobs.stage_two(spark, database, StageTwoOptions(top_n=1))
    assert rows(outcome.board) == [(1, "w2", 30.0, 300.0, 1)]
    assert spark.table(f"{database}.stg_profitable_flippers").count() == 2
    assert rows(outcome.board_trades, "wallet_address", "trade_no") == [("w2", 1)]
    assert jobs.label_wallets(spark, database) == 2
    # Finished jobs leave no intermediate table.
    assert set(staged_folders(spark)) == before
    assert rows(spark.table(f"{database}.dim_wallet_labels"), "wallet_address", "success_rate", "total_pnl_pct") == [
        ("w1", 1.0, 300.0), ("w2", 1.0, 300.0)]


def test_missing_tables_fail_the_verification(spark, frame, database, tmp_path):
    frame(LOGS, swap("2022-01-01", "t", "p", "0x")).write.parquet(str(tmp_path / "logs"))
    report = jobs.verify(spark, database, str(tmp_path / "logs"))
    assert not report.passed
    assert report.completeness.where("passed").isEmpty()


def test_readers_select_and_order(spark, frame):
    pools = frame("pool_address string, pool_name string, dex_protocol string, chain string", ("1", "b", "y", "c"),
                  ("2", "a", "y", "c"), ("3", "z", "x", "c"))
    assert [r[0] for r in readers.pool_names(pools).collect()] == ["3", "2", "1"]
    staged = readers.staged_buys(frame(BUYS, buy("w", "2022-01-01", 1.0, 1.0)).withColumn("extra", F.lit(1)))
    assert staged.columns == schemas.STAGED_BUYS.schema.names
    df = frame("t timestamp", (at("2022-01-01 00:00:00"),), (at("2022-01-02 00:00:00"),), (at("2022-01-02 00:00:01"),))
    assert readers.between_times(df, "t", "2022-01-01", "2022-01-02").count() == 2


def test_command_line_runs_the_steps(spark, frame, database, tmp_path, capsys, monkeypatch):
    from slumptrace import __main__ as command

    monkeypatch.setattr(command, "build_session", lambda: spark)
    token, base, pool = 0x10, int("c02aaa39b223fe8d0a0e5c4f27ead9083c756cc2", 16), 0xF0
    sinks.write_table(frame(EVENTS, event("c1", address(token), "2022-01-10", "2022-01-12")), database, schemas.CRISIS_EVENTS)
    sinks.write_table(frame(PRICES, *[(address(token), p, day(d)) for p, d in (
        (10.0, "2022-01-03"), (5.0, "2022-01-11"), (20.0, "2022-02-01"))]), database, schemas.PRICES, fill_missing=True)
    frame(LOGS, pair_created(token, base, pool),
          swap("2022-01-11 10:00:00", "t1", address(pool), payload(0, UNIT, UNIT, 0))).write.parquet(str(tmp_path / "logs"))
    frame(TRANSACTIONS, ("t1", "w1")).write.parquet(str(tmp_path / "tx"))
    place = ["--database", database, "--logs", str(tmp_path / "logs")]
    assert command.main(["pools", *place, "--drop"]) == 0
    assert command.main(["verify", *place]) == 1
    assert command.main(["stage-one", *place, "--transactions", str(tmp_path / "tx")]) == 0
    assert command.main(["stage-two", "--database", database, "--top", "3"]) == 0
    assert command.main(["labels", "--database", database, "--dry-run"]) == 0
    more = ["--transactions", str(tmp_path / "tx"), "--hours", "0", "40", "--decimals", "17", "--default-price", "2",
            "--protocol", "Other=0x" + "b" * 40, "--dry-run"]
    assert command.main(["stage-one", *place, *more]) == 0
    assert command.main(["realised", *place, *more, "--recovery-days", "30"]) == 0
    assert command.main(["crises", "--database", database, "--max-return-pct", "-40", "--max-drain-pct", "-99", "--dry-run"]) == 0
    with pytest.raises(SystemExit):
        command.main(["stage-one", *place, "--transactions", "t", "--protocol", "Other=1"])
    printed = capsys.readouterr().out
    assert "1 pools" in printed and "1 buys" in printed and "1 wallets" in printed and "|300.0" in printed


RAW = [swap("2022-01-01 10:00:00", "t1", "0xAB", "0x1", 0), swap("2022-01-01 11:00:00", "t1", "0xab", "0x2", 1),
       swap("2022-01-02 10:00:00", "t2", "0xCD", "0x3", 0), swap("2022-01-04 10:00:00", "t3", "0xEF", "0x4", 0)]


def test_storing_a_day_twice_changes_nothing(spark, frame, tmp_path):
    from slumptrace.sources import logstore

    store, held = str(tmp_path / "store"), lambda: rows(logstore.load_logs(spark, store), "transaction_hash", "log_index", "address", "block_date")
    assert logstore.append_logs(frame(LOGS, *RAW[:3], RAW[0]), store) == 3
    before = held()
    assert logstore.append_logs(frame(LOGS, *RAW[:3]), store) == 0
    assert logstore.append_logs(frame(LOGS, RAW[1]), store) == 0
    assert held() == before == [("t1", 0, "0xab", day("2022-01-01")), ("t1", 1, "0xab", day("2022-01-01")), ("t2", 0, "0xcd", day("2022-01-02"))]
    # A late log of a day that is there, and a new day.
    late = swap("2022-01-02 23:00:00", "t9", "0xAA", "0x9", 5)
    assert logstore.append_logs(frame(LOGS, late, RAW[2], RAW[3]), store) == 2
    assert len(held()) == 5 and set(before) <= set(held())
    assert logstore.manifest(spark, store)[day("2022-01-02")][1] == 2
    assert rows(logstore.load_logs(spark, store, [day("2022-01-02")]), "transaction_hash") == [("t2",), ("t9",)]
    # Replaced versions are gone, all others are named.
    left = {(p.parent.name.split("=")[1], p.name.split("=")[1]) for p in (tmp_path / "store" / "data").glob("version=*/block_date=*")}
    assert left == {(v, str(d)) for d, (v, _) in logstore.manifest(spark, store).items()}
    assert logstore.append_logs(frame(LOGS), store) == 0


def test_logs_that_no_manifest_covers_are_refused(spark, frame, tmp_path):
    from slumptrace.sources import logstore

    frame(LOGS, *RAW).write.parquet(str(tmp_path / "raw"))
    with pytest.raises(ValueError, match="no manifest"):
        logstore.load_logs(spark, str(tmp_path / "raw"))
    store = str(tmp_path / "store")
    assert jobs.append_logs(spark, str(tmp_path / "raw"), store) == 4
    with pytest.raises(ValueError, match="2022-01-03"):
        logstore.load_logs(spark, store, [day("2022-01-02"), day("2022-01-03")])
    # Raw and stored logs give the same swaps, but only stored ones are compared as they are.
    raw, kept = readers.load(spark, str(tmp_path / "raw")), readers.load(spark, store)
    keys = frame("pool_address string", ("0xab",), ("0xef",))
    found = [readers.swap_logs(df, pool_keys=keys) for df in (raw, kept)]
    assert rows(found[0], "transaction_hash", "pool_address") == rows(found[1], "transaction_hash", "pool_address") == [
        ("t1", "0xab"), ("t1", "0xab"), ("t3", "0xef")]
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in found]
    assert "lower(address" in plans[0] and "lower(address" not in plans[1]


def test_a_failed_append_leaves_the_store_as_it_was(spark, frame, tmp_path, monkeypatch):
    from slumptrace.sources import logstore

    store = str(tmp_path / "store")
    logstore.append_logs(frame(LOGS, *RAW[:2]), store)
    monkeypatch.setattr(logstore, "laid_out", lambda df: df.withColumn("data", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        logstore.append_logs(frame(LOGS, *RAW), store)
    monkeypatch.undo()
    assert logstore.load_logs(spark, store).count() == 2
    assert logstore.append_logs(frame(LOGS, *RAW), store) == 2 and logstore.load_logs(spark, store).count() == 4
