"""Replacing a whole table, after checking what is about to be written."""

from __future__ import annotations

import logging
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType,
    TimestampNTZType, TimestampType,
)

from slumptrace.operators.scale import delete_folder, materialize
from slumptrace.schemas import Table
from slumptrace.sources.catalog import NORMALISED, drop_table, ensure_tables, location, partitions_by_folder, table_ddl

log = logging.getLogger(__name__)

# The folder beside a table's first one that holds its later versions.
_VERSIONS = "-versions"

# Types of one kind may be cast into each other.
_KINDS = ((StringType,), (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType),
          (DateType,), (TimestampType, TimestampNTZType))


def require_schema(df: DataFrame, table: Table, optional: bool = False) -> None:
    """Fail when a column of ``table`` is missing in ``df`` or of another kind, before anything is cast.

    With ``optional`` columns that may be null may be missing as well.
    """
    kinds = {kind.__name__: k for k, group in enumerate(_KINDS) for kind in group}
    found = {f.name: kinds.get(type(f.dataType).__name__) for f in df.schema}
    wrong = [f"{f.name} is missing" for f in table.schema if f.name not in found and not (optional and f.nullable)]
    wrong += [f"{f.name} is {df.schema[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}"
              for f in table.schema if f.name in found and found[f.name] != kinds[type(f.dataType).__name__]]
    if wrong:
        raise ValueError(f"{table.name}: {'; '.join(wrong)}")


def conform(df: DataFrame, table: Table) -> DataFrame:
    """The columns of ``table`` in its order and types, addresses in lower case. Columns missing in ``df`` become null."""
    def value(name: str) -> Column:
        if name not in df.columns:
            return F.lit(None)
        return F.lower(name) if name in table.addresses else F.col(name)

    return df.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in table.schema])


def laid_out(df: DataFrame, table: Table) -> DataFrame:
    """Rows in ranges of the partition and clustering columns, so files are few and skip well.

    Ranges also cut a busy day into several tasks, which hashing the day would not. Buckets are dealt out by their own
    column, one file for each.
    """
    if table.buckets:
        return df.repartition(table.buckets, table.cluster_by[0]).sortWithinPartitions(*table.cluster_by)
    keys = list(dict.fromkeys([*table.partition_by, *table.cluster_by]))
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df


def require_keys(df: DataFrame, table: Table) -> None:
    """Fail when a required column holds nulls, which Parquet would accept."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in table.required]).first().asDict()
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise ValueError(f"{table.name}: nulls in required columns {broken}")


def write_table(
    df: DataFrame,
    database: str,
    table: Table,
    dry_run: bool = False,
    validate: Callable[[DataFrame], None] | None = None,
    sample: Callable[[DataFrame], None] | None = None,
    on_empty: str = "warn",
    fill_missing: bool = False,
) -> int:
    """Replace the contents of ``table`` by ``df`` and return the number of rows.

    The result is computed once, into the staging folder; emptiness, validation, sample and load all read
    it from there, so a failed check or a dry run leaves the table as it was. ``on_empty`` is ``warn``
    (leave the table alone) or ``error``. A column that is missing or of another kind fails before anything is
    computed; with ``fill_missing`` columns that may be null are filled with nulls.
    """
    spark = df.sparkSession
    require_schema(df, table, fill_missing)
    staged = materialize(conform(df, table), table.name, compact=True)
    rows = staged.count()
    if rows == 0:
        if on_empty == "error":
            raise ValueError(f"no rows for {table.name}")
        log.warning("no rows for %s, table left as it is", table.name)
        return 0
    require_keys(staged, table)
    if validate is not None:
        validate(staged)
    if sample is not None:
        sample(staged)
    if dry_run:
        log.info("dry run: %d rows for %s not written", rows, table.name)
        return rows
    replace_contents(staged, database, table)
    return rows


def replace_contents(df: DataFrame, database: str, table: Table) -> None:
    """Write ``df`` to a folder of its own and then point the table to it.

    The table shows its old rows until all new ones are written, and after a failure. The switch is one change in the
    catalog; the folder it leaves is deleted afterwards.
    """
    spark = df.sparkSession
    ensure_tables(spark, database, [table])
    old = location(spark, database, table.name)
    version = uuid4().hex
    parent = old.rsplit("/", 1)[0] if f"/{table.name}{_VERSIONS}/" in old else f"{old}{_VERSIONS}"
    new, draft = f"{parent}/{version}", f"{table.name}_{version}"
    full = f"{database}.{table.name}"
    try:
        with partitions_by_folder(spark):
            spark.sql(table_ddl(table, database, draft, new))
        # A table of the same declaration, so that partitions and buckets are laid out as declared.
        laid_out(df, table).write.insertInto(f"{database}.{draft}", overwrite=True)
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{new}'")
    except BaseException:
        drop_table(spark, database, draft)
        delete_folder(spark, new)
        raise
    # The draft names its place itself, so its files stay.
    drop_table(spark, database, draft)
    spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('{NORMALISED}' = 'lower')")
    spark.catalog.refreshTable(full)
    delete_folder(spark, old)
