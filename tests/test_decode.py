from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import PAIR_FACTORY, UNIT, address, payload, topic
from slumptrace.functions import hexdata, logs
from slumptrace.operators import swaps


def test_words_and_amounts(frame):
    data = payload(1 * UNIT, 2 * UNIT, 3 * UNIT, 4 * UNIT)
    df = frame("data string", (data,), (data[:194],), (data[:193],), (None,), ("",), ("0x",))
    got = [r[0] for r in df.select(hexdata.word_amount(F.col("data"), 2, 18)).collect()]
    assert got == [3.0, 3.0, None, None, None, None]


def test_bad_hex_is_null(frame):
    bad = ["zz" * 32, "1g" + "0" * 62, "0" * 63 + ".", "." + "0" * 63, " " + "0" * 63, "p" + "0" * 63, "0x" + "0" * 62,
           "-" + "1" * 63, "1_" + "0" * 62]
    df = frame("data string", *[("0x" + b,) for b in bad])
    assert [r[0] for r in df.select(hexdata.word_amount(F.col("data"), 0, 18)).collect()] == [None] * len(bad)


def test_upper_case_hex(frame):
    df = frame("data string", ("0x" + f"{255 * UNIT:064X}",))
    assert df.select(hexdata.word_amount(F.col("data"), 0, 18)).first()[0] == 255.0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=256).flatmap(
    lambda bits: st.integers(min_value=0, max_value=2**bits - 1 if bits else 0)), min_size=200, max_size=400))
def test_every_width_is_rounded_once(spark, numbers):
    df = spark.createDataFrame([(i, payload(n)) for i, n in enumerate(numbers)], "i int, data string")
    got = dict(df.select("i", hexdata.word_amount(F.col("data"), 0, 18)).collect())
    assert got == {i: float(n) / 1e18 for i, n in enumerate(numbers)}


def test_decimals_may_be_a_column(frame):
    df = frame("data string, d int", (payload(5 * 10**6), 6), (payload(5 * UNIT), 18))
    assert [r[0] for r in df.select(hexdata.word_amount(F.col("data"), 0, F.col("d"))).collect()] == [5.0, 5.0]


SWAP = "token0_address string, token1_address string, crisis_token string, dex_protocol string, data string"


def test_direction_and_word_choice(frame):
    data = payload(1 * UNIT, 2 * UNIT, 3 * UNIT, 4 * UNIT)
    df = frame(SWAP, ("A", "B", "A", "Uniswap V2", data), ("B", "A", "A", "Uniswap V2", data),
               ("A", "A", "A", "Uniswap V2", data), ("B", "C", "A", "Uniswap V2", data),
               ("A", "B", "A", "Other", data))
    for decode, first, second in (("abi", 3.0, 4.0), ("shifted", 2.0, 3.0)):
        got = [r[0] for r in df.select(swaps.bought_amount(decode)).collect()]
        assert got == [first, second, first, None, None]
    assert [r[0] for r in df.select(swaps.sold_amount()).collect()] == [1.0, 2.0, 1.0, None, None]


def test_only_payments_of_the_crisis_token_are_buys(frame):
    sell, short = payload(5 * UNIT, 0, 0, 7 * UNIT), payload(0, 1, UNIT)
    df = frame(SWAP, ("A", "B", "A", "Uniswap V2", sell), ("A", "B", "A", "Uniswap V2", short),
               ("B", "A", "A", "Uniswap V2", short), ("A", "B", "A", "Uniswap V2", None),
               ("A", "B", "A", "Uniswap V2", "0x1234"), ("A", "B", "A", "Uniswap V2", payload(0, 1) + "zz" * 64))
    # The second payload ends after the word that pays out token 0.
    assert [r["token_amount"] for r in swaps.crisis_buys(df).collect()] == [1.0]


def test_one_unit_of_the_token_counts(frame):
    df = frame(SWAP, ("A", "B", "A", "Uniswap V2", payload(0, 1, 1, 0)))
    assert swaps.crisis_buys(df).first()["token_amount"] == 1e-18


def test_log_functions(spark, frame):
    df = frame("topics array<string>, data string, address string",
               ([topic(1), topic(0xAB)], payload(0xCD, 1), PAIR_FACTORY.upper().replace("X", "x")), ([], None, None))
    by_column = df.select(
        logs.topic_address(F.col("topics"), 1), logs.topic_address(F.col("topics"), 2), logs.pair_address(F.col("data")),
        logs.is_known_factory(F.col("address")), logs.protocol_name(F.col("address")),
        logs.has_topic(F.col("topics"), topic(1)),
    ).collect()
    assert tuple(by_column[0]) == (address(0xAB), None, address(0xCD), True, "Uniswap V2", True)
    assert tuple(by_column[1]) == (None, None, None, None, "Unknown", None)
    logs.register_sql_functions(spark)
    by_sql = spark.sql(
        "SELECT extract_token_address(topics, 1), extract_token_address(topics, 2), extract_v2_pair_address(data), "
        "is_known_factory(address), get_dex_protocol(address) FROM {df}", df=df
    ).collect()
    assert [tuple(r) for r in by_sql] == [tuple(r)[:5] for r in by_column]


def test_protocols_with_their_own_layout(frame):
    data = payload(1 * UNIT, 2 * UNIT, 3 * UNIT, 4 * UNIT)
    protocols = (*logs.PROTOCOLS, logs.Protocol("Mirror", "0xf", out0_word=0, out1_word=1))
    df = frame(SWAP, ("A", "B", "A", "Uniswap V2", data), ("A", "B", "A", "Mirror", data), ("B", "A", "A", "Mirror", data),
               ("A", "B", "A", "Other", data))
    assert [r[0] for r in df.select(swaps.bought_amount(protocols=protocols)).collect()] == [3.0, 1.0, 2.0, None]
    factory = frame("address string", ("0xF",), ("0xe",))
    assert [r[0] for r in factory.select(logs.protocol_name(F.col("address"), protocols)).collect()] == ["Mirror", "Unknown"]
