"""A local session for tests and timings. On a cluster the session comes from outside."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the jobs profit from anywhere. Memory and partition counts belong to the cluster.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile a method of more than 8,000 bytes; a stage that would be one is run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffle files go when the statement that wrote them ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def short_methods(spark: SparkSession) -> None:
    """Give a session from outside the limit that keeps wide and nested stages compiled."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, RECOMMENDED[name])


def free_shuffles(spark: SparkSession) -> None:
    """Have a session from outside delete the shuffle files of each statement at its end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(name, RECOMMENDED[name])


def local_session(cpus: int | str = "*", name: str = "chargelake", memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
