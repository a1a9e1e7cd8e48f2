"""Export of gold tables: facts partition by partition, each batch once; dimensions whole.

What is pending is told by run numbers, not by time: a run that came late or was built again is sent like any other.
A batch is one commit of one partition. Its id is written with its facts, and a batch is marked in the target's ledger
after all its facts arrived. An export that was interrupted is made good by the next: a batch that is there whole is
only marked, one that is there in part is removed and sent again. ``exported`` reads the last marked batch of each
partition, so readers see every fact once at any moment, also while a batch replaces an older one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F

from chargelake.sinks.changes import pending_partitions, with_partition
from chargelake.sinks.lakehouse import Lakehouse
from chargelake.staging import fits_broadcast, releasing, staged

FACTS, FACT_PARTITION = "fact_charges", "gold_ingestion_ts"
LEDGER = "export_ledger"
LEDGER_SCHEMA = "table_name string, partition string, run_no bigint, batch_id string, rows bigint"
DIMENSIONS = ("dim_hospital", "dim_payer", "dim_plan", "dim_procedure")


class Target(Protocol):
    def exists(self, table: str) -> bool: ...

    def read(self, table: str) -> DataFrame: ...

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None: ...

    def replace(self, table: str, df: DataFrame) -> None: ...

    def drop_partitions(self, table: str, values: DataFrame) -> None:
        """Delete the rows whose column, the one column of ``values``, has one of these."""


class JdbcTarget:
    """A database schema. Address and login come from the caller, never from here.

    Executors write in parallel over at most ``connections`` connections.
    """

    def __init__(
        self, url: str, schema: str, properties: Mapping[str, str], connections: int = 16, batch_rows: int = 10_000
    ) -> None:
        self.url, self.schema, self.properties = url, schema, dict(properties)
        self.connections, self.batch_rows = connections, batch_rows

    def options(self, table: str) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": f"{self.schema}.{table}" if self.schema else table,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_rows),
        }

    def exists(self, table: str) -> bool:
        connection = self._connect()
        try:
            found = connection.getMetaData()
            names = (table, table.upper(), table.lower())
            schemas = (self.schema, self.schema.upper(), self.schema.lower()) if self.schema else (None,)
            return any(found.getTables(None, schema, name, None).next() for schema in schemas for name in names)
        finally:
            connection.close()

    def read(self, table: str) -> DataFrame:
        return SparkSession.active().read.format("jdbc").options(**self.options(table)).load()

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        df.write.format("jdbc").options(**self.options(table)).mode("append").save()

    def replace(self, table: str, df: DataFrame) -> None:
        """Empty and refill the table, keeping its definition and grants."""
        df.write.format("jdbc").options(**self.options(table), truncate="true").mode("overwrite").save()

    def drop_partitions(self, table: str, values: DataFrame) -> None:
        (name,) = values.columns
        connection = self._connect()
        try:
            connection.setAutoCommit(False)
            statement = connection.prepareStatement(f"DELETE FROM {self.options(table)['dbtable']} WHERE {name} = ?")
            for row in values.toLocalIterator():
                statement.setObject(1, row[0])
                statement.addBatch()
            statement.executeBatch()
            connection.commit()
        finally:
            connection.close()

    def _connect(self):
        """A connection of the driver's own; the driver class must be on its class path."""
        jvm = SparkSession.active()._jvm
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        properties = jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, str(value))
        return jvm.java.sql.DriverManager.getConnection(self.url, properties)


def _ledger(target: Target, spark: SparkSession) -> DataFrame:
    marked = target.read(LEDGER) if target.exists(LEDGER) else spark.createDataFrame([], LEDGER_SCHEMA)
    return marked.filter(F.col("table_name") == FACTS)


def _last_marked(ledger: DataFrame) -> DataFrame:
    last = ledger.groupBy("partition").agg(F.max(F.struct("run_no", "batch_id")).alias("last"))
    return last.select(F.col("last.batch_id").alias("batch_id"))


def _drop_batches(target: Target, batches: DataFrame) -> None:
    if not batches.isEmpty():
        target.drop_partitions(FACTS, batches.select("batch_id"))


def exported(target: Target, spark: SparkSession) -> DataFrame:
    """The facts of the last marked batch of each partition."""
    return target.read(FACTS).join(_last_marked(_ledger(target, spark)), "batch_id", "left_semi").drop("batch_id")


@releasing
def export_gold(lake: Lakehouse, target: Target) -> bool:
    """Send what was committed since the last export and, if that is anything, the dimensions.

    Returns whether anything was sent. Facts committed meanwhile wait for the next export.
    """
    spark = lake.spark
    if not lake.exists(FACTS):
        return False
    pending = pending_partitions(lake, FACTS, FACT_PARTITION, _ledger(target, spark))
    batch_id = F.concat_ws("-", F.lit(FACTS), "partition", "run_no")
    pending = staged(pending.withColumn("batch_id", batch_id), "pending")
    anything = not pending.isEmpty()
    if anything:
        for table in DIMENSIONS:
            target.replace(table, lake.read(table))
        _send(lake, target, pending)
    if target.exists(FACTS):
        # What a later batch has replaced, or an export left behind that was never marked.
        there = target.read(FACTS).select("batch_id").distinct()
        _drop_batches(target, staged(there.join(_last_marked(_ledger(target, spark)), "batch_id", "left_anti"), "stale"))
    return anything


def _send(lake: Lakehouse, target: Target, pending: DataFrame) -> None:
    """Append the pending batches that the target does not hold whole, then mark them all."""
    wanted = F.broadcast(pending) if fits_broadcast(pending) else pending
    batch = with_partition(lake, FACTS, FACT_PARTITION).join(wanted, "partition")
    sizes = pending.join(batch.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows")), "batch_id", "left")
    if target.exists(FACTS):
        there = target.read(FACTS).groupBy("batch_id").agg(F.count(F.lit(1)).alias("present"))
        sizes = sizes.join(there, "batch_id", "left")
    else:
        sizes = sizes.withColumn("present", F.lit(None).cast("bigint"))
    sizes = staged(sizes.withColumns({"rows": F.coalesce("rows", F.lit(0)), "present": F.coalesce("present", F.lit(0))}), "batches")
    incomplete = sizes.filter("rows <> present")
    _drop_batches(target, incomplete.filter("present > 0"))
    if not incomplete.isEmpty():
        missing = incomplete.select("batch_id")
        missing = F.broadcast(missing) if fits_broadcast(missing) else missing
        target.append(FACTS, batch.join(missing, "batch_id", "left_semi").drop("partition", "run_no"), ["batch_id"])
    target.append(LEDGER, sizes.select(F.lit(FACTS).alias("table_name"), "partition", "run_no", "batch_id", "rows"))
