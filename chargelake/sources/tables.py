"""Reads of catalog tables: whole, above a high-water mark, listed, looked up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def high_mark(df: DataFrame, column: str) -> Column | None:
    """The highest timestamp of a column as a literal exact to the microsecond; None without rows."""
    micros = df.agg(F.max(F.unix_micros(column))).first()[0]
    return None if micros is None else F.timestamp_micros(F.lit(micros))


def rows_after(df: DataFrame, column: str, mark: Column | None) -> DataFrame:
    """Rows above the mark; all rows while there is none. On the column a table is partitioned by,
    older partitions are not read."""
    return df if mark is None else df.filter(F.col(column) > mark)


def lookup_equal(df: DataFrame, column: str, value: str, show: Sequence[str], limit: int = 10) -> DataFrame:
    """A few rows of one code or name; ordered by what is shown, so the answer is the same each time."""
    return df.filter(F.col(column) == value).select(*show).orderBy(*show).limit(limit)


def distinct_values(df: DataFrame, column: str, limit: int = 100) -> DataFrame:
    return df.select(column).distinct().orderBy(column).limit(limit)


def describe_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Name and column count of each table of a namespace, from the catalog alone."""
    names = sorted(table.name for table in spark.catalog.listTables(namespace) if not table.isTemporary)
    rows = [(name, len(spark.catalog.listColumns(f"{namespace}.{name}"))) for name in names]
    return spark.createDataFrame(rows, "table_name string, columns bigint")


def describe_columns(spark: SparkSession, namespace: str) -> DataFrame:
    """Name and type of each column of each table of a namespace, in order, from the catalog alone."""
    names = sorted(table.name for table in spark.catalog.listTables(namespace) if not table.isTemporary)
    rows = [
        (name, place, column.name, column.dataType)
        for name in names for place, column in enumerate(spark.catalog.listColumns(f"{namespace}.{name}"), 1)
    ]
    return spark.createDataFrame(rows, "table_name string, place int, column_name string, data_type string")
