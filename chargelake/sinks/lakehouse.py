"""Managed tables of one namespace."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chargelake.sources.tables import high_mark, rows_after

WATERMARKS = "etl_watermark"
DROPPED_TOGETHER = 200
GROUP_BYTES = 64 << 20


def _literal(value: object) -> str:
    """A partition value in a statement. Times are written with all their microseconds."""
    quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"TIMESTAMP '{quoted}'" if isinstance(value, datetime) else f"'{quoted}'"


class Lakehouse:
    """Creates, replaces, appends to and drops tables.

    ``table_format`` "parquet" uses the session catalog. Any other, such as "iceberg", is taken to be a
    catalog of version 2 tables, named in the namespace, and is written through ``writeTo``.
    """

    def __init__(
        self, spark: SparkSession, namespace: str, location: str | None = None, table_format: str = "parquet"
    ) -> None:
        self.spark, self.namespace, self.table_format = spark, namespace, table_format
        self._v2 = table_format != "parquet"
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{place}")

    def full_name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(table))

    def read(self, table: str) -> DataFrame:
        """The table as it is now, also when a stream's own session has written it."""
        if not self._v2:
            self.spark.catalog.refreshTable(self.full_name(table))
        return self.spark.read.table(self.full_name(table))

    def read_or_empty(self, table: str, schema: str) -> DataFrame:
        return self.read(table) if self.exists(table) else self.spark.createDataFrame([], schema)

    def replace(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        if self._v2:
            self._writer(table, df, partition_by).createOrReplace()
            return
        # The codec is kept with the table and holds for later inserts.
        writer = df.write.format(self.table_format).mode("overwrite").option("compression", "zstd")
        if partition_by:
            # Kept with the table: later overwrites touch only the partitions they hold.
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        writer.saveAsTable(self.full_name(table))

    def replace_indexed(self, table: str, df: DataFrame, column: str, distinct: int, group_bytes: int = GROUP_BYTES) -> None:
        """Replace a table by files in which a value of ``column`` is found without reading the rest.

        Rows are sorted over all files, so that few row groups' ranges hold a value, and each row group has a Bloom filter
        for values that lie within its range but not in it. ``distinct`` is about how many values a row group holds.
        Rows of a frequent value go to as many files as they need.
        """
        place = "_row"
        spread = df.withColumn(place, F.monotonically_increasing_id()).repartitionByRange(column, place)
        writer = spread.sortWithinPartitions(column, place).drop(place).write.format(self.table_format).mode("overwrite")
        writer.options(**{
            f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.expected.ndv#{column}": str(distinct),
            "parquet.block.size": str(group_bytes),
        }).saveAsTable(self.full_name(table))

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Append by column name, creating the table when it is missing."""
        if not self.exists(table):
            self.replace(table, df, partition_by)
        elif self._v2:
            df.writeTo(self.full_name(table)).append()
        else:
            self._in_table_order(table, df).write.insertInto(self.full_name(table))

    def overwrite_partitions(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        """Write the partitions that ``df`` holds, in place of what they held; others stay.

        A run that is repeated after a failure leaves the same rows as one that went through.
        """
        if not self.exists(table):
            self.replace(table, df, partition_by)
        elif self._v2:
            df.writeTo(self.full_name(table)).overwritePartitions()
        else:
            self._in_table_order(table, df).write.insertInto(self.full_name(table), overwrite=True)

    def drop_partitions(self, table: str, values: DataFrame) -> None:
        """Delete the rows of a table whose partition column, the one column of ``values``, has one of these.

        One statement drops up to ``DROPPED_TOGETHER`` partitions.
        """
        (name,) = values.columns
        rows = values.toLocalIterator()
        while batch := [_literal(row[0]) for row in islice(rows, DROPPED_TOGETHER)]:
            if self._v2:
                self.spark.sql(f"DELETE FROM {self.full_name(table)} WHERE {name} IN ({', '.join(batch)})")
            else:
                listed = ", ".join(f"PARTITION ({name} = {value})" for value in batch)
                self.spark.sql(f"ALTER TABLE {self.full_name(table)} DROP IF EXISTS {listed}")

    def drop(self, tables: Sequence[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.full_name(table)}")

    def watermark(self, table: str) -> Column | None:
        """The highest timestamp of ``table`` exported so far."""
        if not self.exists(WATERMARKS):
            return None
        return high_mark(self.read(WATERMARKS).filter(F.col("table_name") == table), "high_ts")

    def advance_watermark(self, table: str, exported: DataFrame, column: str) -> None:
        mark = exported.agg(F.max(column).alias("high_ts")).select(F.lit(table).alias("table_name"), "high_ts")
        self.append(WATERMARKS, mark)

    def pending(self, table: str, column: str) -> DataFrame:
        return rows_after(self.read(table), column, self.watermark(table))

    def _in_table_order(self, table: str, df: DataFrame) -> DataFrame:
        return df.select(*self.read(table).columns)

    def _writer(self, table: str, df: DataFrame, partition_by: Sequence[str]):
        writer = df.writeTo(self.full_name(table)).using(self.table_format)
        if self.table_format == "iceberg":
            writer = writer.tableProperty("format-version", "2")
        return writer.partitionedBy(*[F.col(name) for name in partition_by]) if partition_by else writer
