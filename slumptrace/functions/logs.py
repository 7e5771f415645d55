"""Column functions over event-log fields, also available as SQL functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from slumptrace.constants import PAIR_CREATED_TOPIC, PAIR_FACTORY, PAIR_PROTOCOL, SWAP_TOPIC, UNKNOWN_PROTOCOL

# An address is the last 40 of the 64 digits of a word, which begins after the 0x prefix.
_ADDRESS_START = 27
_ADDRESS_DIGITS = 40


@dataclass(frozen=True)
class Protocol:
    """How one exchange protocol is recognised: its factory, its two events, and which words of a swap hold the amounts."""

    name: str
    factory: str
    out0_word: int = 2
    out1_word: int = 3
    in0_word: int = 0
    in1_word: int = 1
    swap_topic: str = SWAP_TOPIC
    pair_topic: str = PAIR_CREATED_TOPIC


PROTOCOLS = (Protocol(PAIR_PROTOCOL, PAIR_FACTORY),)


def has_topic(topics: Column, topic: str, position: int = 0) -> Column:
    """Whether the topic at ``position`` equals ``topic``; null when the list is too short."""
    return F.get(topics, F.lit(position)) == F.lit(topic)


def topic_address(topics: Column, position: int) -> Column:
    """The address held by the topic at ``position``, lower-cased; null when the list is too short."""
    return pair_address(F.get(topics, F.lit(position)))


def pair_address(data: Column) -> Column:
    """The address held by the first word of a payload, lower-cased."""
    return F.lower(F.concat(F.lit("0x"), F.substring(data, _ADDRESS_START, _ADDRESS_DIGITS)))


def is_known_factory(address: Column, protocols: Sequence[Protocol] = PROTOCOLS) -> Column:
    return F.lower(address).isin([p.factory for p in protocols])


def protocol_name(address: Column, protocols: Sequence[Protocol] = PROTOCOLS) -> Column:
    """Name of the protocol whose factory has this address, else ``Unknown``."""
    name = F.lit(UNKNOWN_PROTOCOL)
    for protocol in protocols:
        name = F.when(F.lower(address) == protocol.factory, protocol.name).otherwise(name)
    return name


def prefixed_address(address: Column) -> Column:
    """Lower-cased address that surely begins with ``0x``."""
    lowered = F.lower(address)
    return F.when(lowered.startswith("0x"), lowered).otherwise(F.concat(F.lit("0x"), lowered))


def register_sql_functions(spark: SparkSession, protocols: Sequence[Protocol] = PROTOCOLS) -> None:
    """Offer the log functions to SQL text. They are SQL expressions, so Catalyst inlines them."""
    address = f"lower(concat('0x', substr({{0}}, {_ADDRESS_START}, {_ADDRESS_DIGITS})))"
    factories = ", ".join(f"'{p.factory}'" for p in protocols)
    names = " ".join(f"WHEN '{p.factory}' THEN '{p.name}'" for p in protocols)
    for signature, kind, body in (
        ("extract_token_address(topics ARRAY<STRING>, topic_index INT)", "STRING",
         address.format("get(topics, topic_index)")),
        ("extract_v2_pair_address(data STRING)", "STRING", address.format("data")),
        ("is_known_factory(address STRING)", "BOOLEAN", f"lower(address) IN ({factories})"),
        ("get_dex_protocol(address STRING)", "STRING",
         f"CASE lower(address) {names} ELSE '{UNKNOWN_PROTOCOL}' END"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
