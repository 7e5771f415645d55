"""Small column helpers: validity of keys, numbers and percent changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slumptrace.constants import ADDRESS_LENGTH, ZERO_ADDRESS


def valid_wallet(wallet: Column) -> Column:
    """A filter for wallets that are known and not the zero address; null, which a filter drops, for null."""
    return ~wallet.isin("", ZERO_ADDRESS)


def valid_key(key: Column) -> Column:
    """A filter for keys that hold something; null, which a filter drops, for null."""
    return ~key.isin("", "nan")


def well_formed_address(address: Column) -> Column:
    return F.length(address) == ADDRESS_LENGTH


def number(value: Column) -> Column:
    """The value as a double; null when it is no number. NaN, which Spark ranks above all numbers, is null too."""
    double = value.try_cast("double")
    return F.when(~F.isnan(double), double)


def pct_change(before: Column, after: Column) -> Column:
    """Change from ``before`` to ``after`` in percent of ``before``; null when ``before`` is 0."""
    return F.try_divide(after - before, before) * 100.0
