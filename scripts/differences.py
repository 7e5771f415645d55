"""Compare a result with its SQL counterpart, whatever the order of rows and columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import duckdb

from slumptrace.workload.views import TEST_TABLES

# The type names of both engines.
_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def open_oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TEST_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def differences(
    dtypes: Sequence[tuple[str, str]], rows: Sequence[Sequence], oracle: duckdb.DuckDBPyConnection, text: str
) -> list[str]:
    """What differs: column names, types, row counts or values. Empty when nothing does."""
    result = oracle.execute(text)
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    names = sorted(kinds)
    ours = {name: _TYPES.get(kind, kind) for name, kind in dtypes}
    if sorted(ours) != names:
        return [f"columns {sorted(ours)} != {names}"]
    found = [f"type of {n}: {ours[n]} != {kinds[n]}" for n in names if ours[n] != kinds[n]]
    if len(rows) != len(expected):
        found.append(f"rows {len(rows)} != {len(expected)}")
    left = Counter(tuple(row[list(ours).index(n)] for n in names) for row in rows)
    right = Counter(tuple(row[list(kinds).index(n)] for n in names) for row in expected)
    for label, extra in (("only here", left - right), ("only in SQL", right - left)):
        if extra:
            found.append(f"{sum(extra.values())} {label}, such as {next(iter(extra))}")
    return found
