"""New-file pickup as a stream: the checkpoint remembers which files were seen."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from chargelake.operators.flatten import KNOWN_HOSPITAL_IDS
from chargelake.plans.jobs import repaired_files, take_files
from chargelake.sinks.lakehouse import Lakehouse
from chargelake.sources.files import list_files, listed_columns
from chargelake.staging import released, staged

# Fixed value: the columns of Spark's file source.
LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def start_pickup(
    lake: Lakehouse,
    folder: str,
    checkpoint: str,
    run_ts: datetime | Column | None = None,
    files_per_batch: int = 1000,
    known_ids: Mapping[str, str] | DataFrame = KNOWN_HOSPITAL_IDS,
    file_format: str = "json",
    on_conflict: str = "reject",
    on_duplicate: str = "take",
) -> StreamingQuery:
    """Ingest the new files of a folder, known by their whole path, into bronze and the registry, then stop.

    The stream is one of files, not of their rows, so that files without rows are accounted for too; each batch of files
    goes the way of ``ingest``, with the same checks. A batch repeated after a failure replaces the partitions of its own
    files and enters none twice. A stream never sees a path again, so files that were rejected and have changed since are
    taken first. ``checkpoint`` must lie in shared storage. ``run_ts`` is the run that the files belong to, the current
    time of each batch by default.
    """

    def take(listing: DataFrame) -> None:
        stamp = F.current_timestamp() if run_ts is None else run_ts
        take_files(lake, listing, stamp, on_conflict=on_conflict, known_ids=known_ids, file_format=file_format, on_duplicate=on_duplicate)

    def take_batch(batch: DataFrame, _: int) -> None:
        with released(lake.spark):
            take(staged(batch, "batch"))

    with released(lake.spark):
        repaired = staged(repaired_files(lake, list_files(lake.spark, folder, file_format)), "repaired")
        if not repaired.isEmpty():
            take(repaired)
    files = lake.spark.readStream.format("binaryFile").schema(LISTING).option("recursiveFileLookup", True)
    files = files.option("maxFilesPerTrigger", files_per_batch).load(folder)
    writer = listed_columns(files, file_format).writeStream.foreachBatch(take_batch)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
