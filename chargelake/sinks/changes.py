"""A log of commits to partitions, and the feed of those that a reader has not taken yet.

Each write of a partition gets the next run number, whatever time the partition stands for. So a run that is delivered
late, or built once more, is new to a reader that compares run numbers, where one that compares times would miss it.
A commit is entered before and after the write; a partition whose last commit did not end is not offered until its run
is repeated. A commit that leaves the same rows as the one before, by their number and the sum of their hashes, keeps
its version, and readers are not offered it again. One job at a time writes a table. Partitions that were written without the log count as run 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from chargelake.sinks.lakehouse import Lakehouse

COMMITS = "commit_log"
COMMITS_SCHEMA = "table_name string, partition string, run_no bigint, done boolean, version bigint, rows bigint, checksum decimal(38,0)"


def partition_key(column: Column, kind: T.DataType) -> Column:
    """A partition's value as text that no session setting changes; NULL is a value."""
    value = F.unix_micros(column) if isinstance(kind, T.TimestampType) else column
    return F.coalesce(value.cast("string"), F.lit("__NULL__"))


def commits(lake: Lakehouse, table: str) -> DataFrame:
    """The last commit to each partition of a table: partition, run_no, done, version, rows, checksum."""
    log = lake.read_or_empty(COMMITS, COMMITS_SCHEMA).filter(F.col("table_name") == table)
    last = log.groupBy("partition").agg(F.max(F.struct("run_no", "done", "version", "rows", "checksum")).alias("last"))
    return last.select("partition", "last.*")


def commit_partition(lake: Lakehouse, table: str, df: DataFrame, column: str, value: Column) -> int:
    """Make ``df`` the whole of the partition with this value, also when it is empty; returns the run number.

    A repeated call after a failure leaves the same rows under a new number.
    """
    log = lake.read_or_empty(COMMITS, COMMITS_SCHEMA).filter(F.col("table_name") == table)
    kind = df.schema[column].dataType
    one = lake.spark.range(1).select(value.cast(kind).alias(column))
    key = one.select(partition_key(F.col(column), kind)).first()[0]
    number = (log.agg(F.max("run_no")).first()[0] or 0) + 1
    before = commits(lake, table).filter((F.col("partition") == key) & F.col("done")).first()

    def enter(done: bool, *content: object) -> None:
        entry = (table, key, number, done, *(content or (None, None, None)))
        lake.append(COMMITS, lake.spark.createDataFrame([entry], COMMITS_SCHEMA))

    enter(False)
    if not df.isEmpty():
        lake.overwrite_partitions(table, df, [column])
    elif lake.exists(table):
        lake.drop_partitions(table, one)
    else:
        lake.replace(table, df, [column])
    kept = lake.read(table)
    same = partition_key(F.col(column), kind) == key
    summed = F.sum(F.xxhash64(*kept.columns).cast("decimal(20,0)")).cast("decimal(38,0)")
    rows, checksum = kept.filter(same).agg(F.count(F.lit(1)), F.coalesce(summed, F.lit(0).cast("decimal(38,0)"))).first()
    unchanged = before is not None and (before.rows, before.checksum) == (rows, checksum)
    enter(True, before.version if unchanged else number, rows, checksum)
    return number


def with_partition(lake: Lakehouse, table: str, column: str, name: str = "partition") -> DataFrame:
    rows = lake.read(table)
    return rows.withColumn(name, partition_key(F.col(column), rows.schema[column].dataType))


def pending_partitions(lake: Lakehouse, table: str, column: str, taken: DataFrame) -> DataFrame:
    """(partition, run_no) of what was committed to a table and is not in ``taken``, which has the same columns.

    ``run_no`` is the version: the number of the run that first left the partition's present rows.
    Only the partition column is read, and only to find partitions without a commit.
    """
    known = commits(lake, table)
    unlogged = with_partition(lake, table, column).select("partition").distinct().join(known, "partition", "left_anti")
    offered = known.filter("done").select("partition", F.col("version").alias("run_no"))
    offered = offered.unionByName(unlogged.select("partition", F.lit(0).cast("bigint").alias("run_no")))
    return offered.join(taken.select("partition", "run_no"), ["partition", "run_no"], "left_anti")


def unfinished_partitions(lake: Lakehouse, table: str) -> DataFrame:
    """Partitions whose last write did not end; repeating their run mends them."""
    return commits(lake, table).filter("NOT done").select("partition", "run_no")
