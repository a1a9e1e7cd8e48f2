"""Scratch tables that cut lineage, and the size check that every broadcast goes through."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BROADCAST_BYTES = 32 << 20
# For rows of megabytes: the writer looks at the size of its pages and row groups after each row, not after a hundred,
# and readers hold one row group at a time.
LONG_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}

_local_scratch: tempfile.TemporaryDirectory | None = None
_prepared: set[str] = set()
_scope: ContextVar[list[str] | None] = ContextVar("scratch tables of the running job", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may go without that setting. What an application puts there is removed when
    it ends.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="chargelake-")
        root = _local_scratch.name
    folder = f"{root.rstrip('/')}/chargelake/{spark.sparkContext.applicationId}"
    if folder not in _prepared:
        _prepare(spark, folder)
        _prepared.add(folder)
    return f"{folder}/{label}-{uuid4().hex}"


def _prepare(spark: SparkSession, folder: str) -> None:
    """Create the application's folder and have its file system delete it at the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)


def staged(df: DataFrame, label: str, compression: str = "snappy", **options: str) -> DataFrame:
    """Write ``df`` once and read it back, so later uses share one result that outlives executors.

    ``options`` are those of the Parquet writer, see ``LONG_ROWS``.
    """
    path = scratch_path(df.sparkSession, label)
    if (held := _scope.get()) is not None:
        held.append(path)
    df.write.options(**options).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables written within, by this thread, at the end. Nothing read from them may live on."""
    held: list[str] = []
    before = _scope.set(held)
    try:
        yield
    finally:
        _scope.reset(before)
        for path in held:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def releasing(job: Callable) -> Callable:
    """A job on a lakehouse, its first argument, that leaves no scratch tables. It must not return rows."""

    @wraps(job)
    def run(lake, *more, **named):
        with released(lake.spark):
            return job(lake, *more, **named)

    return run


def fits_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` in one aggregate and compare it with the limit."""
    fixed, varying = 16, []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            varying.append(F.octet_length(F.col(f"`{field.name}`")))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            varying.append(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))))
        else:
            fixed += 8
    row_bytes = F.lit(fixed)
    for part in varying:
        row_bytes = row_bytes + F.coalesce(part, F.lit(0))
    total = df.agg(F.sum(row_bytes.cast("bigint"))).first()[0]
    return (total or 0) <= limit_bytes
