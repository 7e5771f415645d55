"""Databases and tables of the data model."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slumptrace.schemas import TABLES, Table


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Set on tables whose addresses the sink has written in lower case.
NORMALISED = "addresses"


def table_ddl(table: Table, database: str, name: str | None = None, location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with nullability, comments, partitions and buckets."""
    columns = ",\n  ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'} "
        f"COMMENT {_quoted(f.metadata['comment'])}"
        for f in table.schema
    )
    layout = f"\nPARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
    if table.buckets:
        # Partition columns have one value per file and cannot be named again.
        order = [c for c in table.cluster_by if c not in table.partition_by]
        layout += f"\nCLUSTERED BY ({order[0]}) SORTED BY ({', '.join(order)}) INTO {table.buckets} BUCKETS"
    if location:
        layout += f"\nLOCATION {_quoted(location)}"
    return (
        f"CREATE TABLE IF NOT EXISTS {database}.{name or table.name} (\n  {columns}\n)\nUSING parquet{layout}"
        f"\nCOMMENT {_quoted(table.comment)}"
    )


def location(spark: SparkSession, database: str, name: str) -> str:
    """The folder a table is read from."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def is_normalised(spark: SparkSession, database: str, name: str) -> bool:
    """Whether the sink has written the table, so that its addresses are in lower case."""
    found = spark.sql(f"SHOW TBLPROPERTIES {database}.{name}").where(F.col("key") == NORMALISED).collect()
    return bool(found) and found[0]["value"] == "lower"


@contextmanager
def partitions_by_folder(spark: SparkSession) -> Iterator[None]:
    """Tables created meanwhile find their partitions below their location, instead of keeping a list of their own.

    Only then a change of the location changes all partitions at once.
    """
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def drop_table(spark: SparkSession, database: str, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def ensure_tables(
    spark: SparkSession, database: str, tables: Iterable[Table] = tuple(TABLES.values()), drop: bool = False
) -> list[str]:
    """Create the database and its missing tables; with ``drop`` the tables are created anew."""
    ensure_database(spark, database)
    for table in tables:
        if drop:
            drop_table(spark, database, table.name)
        with partitions_by_folder(spark):
            spark.sql(table_ddl(table, database))
    return list_tables(spark, database)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def empty(spark: SparkSession, table: Table) -> DataFrame:
    """A frame with the columns of ``table`` and no rows."""
    return spark.createDataFrame([], table.schema)
