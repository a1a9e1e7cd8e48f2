"""The jobs of the lakehouse, from new hospital files to exported gold tables.

Each job is safe to repeat with the same run timestamp: it replaces the partitions it wrote before, or
appends only what is missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, functions as F

from chargelake import schemas
from chargelake.operators import dimensions, history, quality
from chargelake.operators.clean import CLEANERS
from chargelake.operators.enrich import enrich, stamp
from chargelake.operators.flatten import HEADER, KNOWN_HOSPITAL_IDS, align_csv_groups, flatten_documents
from chargelake.operators.score import score
from chargelake.plans.layout import bronze_rows, compact_bronze
from chargelake.sinks.changes import commit_partition
from chargelake.sinks.export import FACT_PARTITION, FACTS, Target, export_gold
from chargelake.sinks.lakehouse import Lakehouse
from chargelake.sources import drift
from chargelake.sources.files import (
    ENDINGS, conflicting_files, content_marks, files_to_ingest, list_files, redelivered_files, scan_csv, scan_documents, with_source,
)
from chargelake.sources.split_json import scan_split_documents
from chargelake.staging import releasing, staged

REGISTRY = "ingest_registry"
CSV_VARIANT = 3
REJECTED_FILES = "rejected_files"
UNKNOWN_VALUES = "unknown_values"
FILE_CONTENTS = "file_contents"
HOSPITAL_STATES = "hospital_states"
FILE_COLUMNS = ("source_path", "source_name", "source_id", "length")
FILES_PER_BATCH = 10_000
SPLIT_BYTES = 64 << 20  # Spark holds all documents of a file that is one array at once, at many times their length
WHOLE_ENDINGS = (".gz", ".zst")  # compressed so that one task must read the whole file
CORRUPT, REASON = REJECTED = ("corrupt_record", "reason")
REGISTRY_SCHEMA = "source_path string, source_name string, source_id string, length bigint, hospital_id string, run_ts timestamp"
KEYED_DIMENSIONS = {
    "dim_payer": ("payer_id bigint, payer_name string", dimensions.payer_additions),
    "dim_plan": ("plan_id bigint, plan_name string", dimensions.plan_additions),
}
ATTRIBUTE_DIMENSIONS = {"dim_hospital": schemas.DIM_HOSPITAL, "dim_procedure": schemas.DIM_PROCEDURE}


def write_bronze(
    lake: Lakehouse, docs: DataFrame, spread: bool, known_ids: Mapping[str, str] | DataFrame = KNOWN_HOSPITAL_IDS
) -> None:
    """Flatten documents that carry ``source_id`` into their bronze partitions, in one pass.

    Hospitals without an id get the one that ``known_ids`` has for their name. What is no hospital document leaves
    one row with its header, see ``rejected_documents``; what did not parse leaves its text, see ``rejected_records``.
    """
    marks = {name: F.lit(None).cast("string") for name in REJECTED if name not in docs.columns}
    docs = docs.withColumns(marks)
    broken = F.coalesce(*REJECTED[::-1]).isNotNull()
    unread = F.when(F.col(CORRUPT).isNotNull(), F.lit("document does not parse"))
    docs = docs.withColumn(REASON, F.coalesce(REASON, unread)).withColumns({
        name: F.when(~broken, F.col(name)) for name in ("license_information", "standard_charge_information")})
    rows = flatten_documents(docs, ["source_id", *REJECTED], spread, keep_unknown=True, known_ids=known_ids, estimates=True)
    _write_sources(lake, rows, spread)


def write_bronze_csv(lake: Lakehouse, wide: DataFrame, spread: bool) -> None:
    """Align wide CSV rows that carry ``source_id`` into their bronze partitions.

    Lines that do not fit the header are no charges; they are kept as they stand.
    """
    if CORRUPT not in wide.columns:
        wide = wide.withColumn(CORRUPT, F.lit(None).cast("string"))
    fits = F.col(CORRUPT).isNull()
    wide = wide.withColumns({
        REASON: F.when(~fits, F.lit("line does not fit the header")), "document_variant": F.when(fits, F.lit(CSV_VARIANT))})
    rows = align_csv_groups(wide, extra=["source_id", *REJECTED, "document_variant"])
    emptied = [F.when(F.col(REASON).isNull(), F.col(name)).alias(name) for name in schemas.BRONZE]
    _write_sources(lake, rows.select("source_id", *REJECTED, "document_variant", *emptied), spread)


def _write_sources(lake: Lakehouse, rows: DataFrame, spread: bool) -> None:
    lake.overwrite_partitions("bronze_charges", rows.hint("rebalance", "source_id") if spread else rows, ["source_id"])


def bronze_charges(lake: Lakehouse) -> DataFrame:
    return _charges_among(bronze_rows(lake))


def _charges_among(rows: DataFrame) -> DataFrame:
    return rows.filter("document_variant IS NOT NULL").drop("document_variant", *REJECTED)


def rejected_documents(lake: Lakehouse) -> DataFrame:
    """Headers of what was found in the files but is no hospital document."""
    return bronze_rows(lake).filter(f"document_variant IS NULL AND {REASON} IS NULL").select("source_id", *HEADER)


def rejected_records(lake: Lakehouse) -> DataFrame:
    """What could not be read: the file, the reason, and the text as far as it is known."""
    rows = bronze_rows(lake).filter(F.col(REASON).isNotNull())
    return rows.select("source_id", REASON, CORRUPT)


def ingest(
    lake: Lakehouse,
    paths: str | Sequence[str],
    run_ts: datetime | Column,
    on_known: str = "skip",
    on_conflict: str = "error",
    on_unknown: str = "reject",
    multi_line: bool = True,
    file_format: str = "json",
    known_ids: Mapping[str, str] | DataFrame = KNOWN_HOSPITAL_IDS,
    csv_options: Mapping[str, str] | None = None,
    split_bytes: int = SPLIT_BYTES,
    on_duplicate: str = "take",
) -> int:
    """Bring files that were not ingested before into bronze; returns how many were accepted.

    The files hold hospital documents, or with ``file_format="csv"`` wide rows under one common header; files of
    another format below the same paths are left to their own run. A file is known by its path and length.
    ``on_known="error"`` stops the run when one is known. A new file that shares its name with a different file stops
    the run, or with ``on_conflict="reject"`` is put into ``rejected_files``. A file without an accepted row is put there
    too and is not recorded as ingested, so its repaired form is taken later. ``on_unknown="error"`` stops the run
    for anything that is no hospital document. Documents over several lines in files of more than ``split_bytes`` are
    read by many tasks. ``on_duplicate="reject"`` puts files aside whose content was accepted under another name; it reads
    each new file once more. Jobs use only what a finished run has recorded.
    """
    listing = list_files(lake.spark, paths, file_format)
    return take_files(
        lake, listing, run_ts, on_known, on_conflict, on_unknown, multi_line, file_format, known_ids, csv_options, split_bytes, on_duplicate)


@releasing
def take_files(
    lake: Lakehouse, listing: DataFrame, run_ts: datetime | Column, on_known: str = "skip", on_conflict: str = "error",
    on_unknown: str = "reject", multi_line: bool = True, file_format: str = "json",
    known_ids: Mapping[str, str] | DataFrame = KNOWN_HOSPITAL_IDS, csv_options: Mapping[str, str] | None = None,
    split_bytes: int = SPLIT_BYTES, on_duplicate: str = "take",
) -> int:
    """``ingest`` of the files of a listing."""
    registry = lake.read_or_empty(REGISTRY, REGISTRY_SCHEMA)
    new = staged(files_to_ingest(listing, registry).select(*FILE_COLUMNS), "new_files")
    if on_known == "error" and new.count() < listing.count():
        raise ValueError("some of the files were ingested before")
    conflicts = conflicting_files(new, registry)
    some = conflicts.limit(5).collect()
    if some and on_conflict == "error":
        raise ValueError(f"files of the same name as others: {[row.source_path for row in some]}")
    if some:
        _reject(lake, conflicts.withColumn("reason", F.lit("another file has this name")), run_ts)
        new = staged(new.join(conflicts.select("source_path"), "source_path", "left_anti").select(*FILE_COLUMNS), "new_files")

    if on_duplicate == "reject" and not new.isEmpty():
        new = _without_redelivered(lake, new, run_ts)

    rows = new.toLocalIterator()
    while batch := list(islice(rows, FILES_PER_BATCH)):
        _take(lake, batch, multi_line, file_format, known_ids, csv_options or {}, split_bytes)
    if on_unknown == "error" and lake.exists("bronze_charges"):
        unknown = lake.read("bronze_charges").filter("document_variant IS NULL").join(new, "source_id", "left_semi").first()
        if unknown is not None:
            raise ValueError(f"{unknown.source_id} holds what is no hospital document of a known variant")
    return record_files(lake, new, run_ts)


def _without_redelivered(lake: Lakehouse, new: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """Put files aside whose content is known; the marks of the others are kept, and count once they are recorded."""
    rows, marks = new.toLocalIterator(), None
    while batch := [row.source_path for row in islice(rows, FILES_PER_BATCH)]:
        more = staged(content_marks(lake.spark, batch), "contents")
        marks = more if marks is None else marks.unionAll(more)
    named = staged(new.join(marks, "source_path", "left"), "marked")
    stored = lake.read_or_empty(FILE_CONTENTS, "source_id string, content string")
    known = stored.join(lake.read_or_empty(REGISTRY, REGISTRY_SCHEMA).select("source_id"), "source_id", "left_semi")
    again = staged(redelivered_files(named.filter("content IS NOT NULL"), known), "again")
    if not again.isEmpty():
        _reject(lake, again.withColumn("reason", F.lit("same content as another file")), run_ts)
    kept = staged(named.join(again.select("source_path"), "source_path", "left_anti"), "kept")
    fresh = kept.filter("content IS NOT NULL").select("source_id", "content").join(stored, ["source_id", "content"], "left_anti")
    lake.append(FILE_CONTENTS, staged(fresh, "fresh"))
    return kept.select(*FILE_COLUMNS)


def _take(
    lake: Lakehouse, batch: Sequence[Row], multi_line: bool, file_format: str, known_ids: Mapping[str, str] | DataFrame,
    csv_options: Mapping[str, str], split_bytes: int,
) -> None:
    """Write one batch of files to bronze."""
    if file_format == "csv":
        options = {name.lower(): value for name, value in csv_options.items()}
        whole = str(options.get("multiline", False)).lower() == "true"
        wide = with_source(scan_csv(lake.spark, [row.source_path for row in batch], corrupt=CORRUPT, **csv_options))
        write_bronze_csv(lake, wide, _outweighs(lake, batch, whole))
        return
    large = [row.source_path for row in batch if multi_line and row.length > split_bytes]
    others = [row for row in batch if not multi_line or row.length <= split_bytes]
    if large:
        write_bronze(lake, scan_split_documents(lake.spark, large), True, known_ids)
    if others:
        docs = scan_documents(lake.spark, [row.source_path for row in others], multi_line, CORRUPT)
        write_bronze(lake, with_source(docs), _outweighs(lake, others, multi_line), known_ids)


def _outweighs(lake: Lakehouse, batch: Sequence[Row], whole: bool) -> bool:
    """Whether a file that one task must read outweighs a task's fair share, so that its rows have to be spread.

    Files that are read in splits need no shuffle: each task writes the rows of its splits to the partitions of their files.
    """
    sizes = [row.length for row in batch if whole or row.source_path.lower().endswith(WHOLE_ENDINGS)]
    return max(sizes, default=0) * lake.spark.sparkContext.defaultParallelism > sum(row.length for row in batch)


def _reject(lake: Lakehouse, files: DataFrame, run_ts: datetime | Column) -> None:
    """Enter files with the reason, each form of a file once."""
    known = lake.read_or_empty(REJECTED_FILES, f"{REGISTRY_SCHEMA}, reason string").select("source_path", "length")
    fresh = files.join(known, ["source_path", "length"], "left_anti").select(*FILE_COLUMNS, "reason")
    lake.append(REJECTED_FILES, staged(stamp(fresh, "run_ts", run_ts), "rejected"))


def repaired_files(lake: Lakehouse, listing: DataFrame) -> DataFrame:
    """Files of a listing that were rejected in another form, by their length, and not taken since."""
    rejected = lake.read_or_empty(REJECTED_FILES, f"{REGISTRY_SCHEMA}, reason string")
    changed = listing.join(rejected.select("source_path").distinct(), "source_path", "left_semi")
    changed = changed.join(rejected.select("source_path", "length"), ["source_path", "length"], "left_anti")
    return files_to_ingest(changed, lake.read_or_empty(REGISTRY, REGISTRY_SCHEMA))


def record_files(lake: Lakehouse, files: DataFrame, run_ts: datetime | Column) -> int:
    """Enter files with an accepted bronze row into the registry, with their first hospital id, others as rejected.

    Files that the registry has already are not entered again. Returns the number of files entered.
    """
    if not lake.exists("bronze_charges"):
        _reject(lake, files.withColumn("reason", F.lit("no charges")), run_ts)
        return 0
    rows = lake.read("bronze_charges").join(files.select("source_id"), "source_id", "left_semi")
    found = rows.groupBy("source_id").agg(
        F.max(F.col("document_variant").isNotNull()).alias("accepted"), F.min("hospital_id").alias("hospital_id"),
        F.min(REASON).alias("unread"))
    judged = staged(files.join(found, "source_id", "left"), "judged")
    entered = judged.filter("accepted").join(lake.read_or_empty(REGISTRY, REGISTRY_SCHEMA), "source_id", "left_anti")
    entered = staged(entered.select(*FILE_COLUMNS, "hospital_id"), "entered")
    rejected = judged.filter("accepted IS NULL OR NOT accepted")
    reason = F.when(F.col("accepted").isNull(), "no charges").otherwise(F.coalesce("unread", F.lit("no hospital document")))
    if not rejected.isEmpty():
        _reject(lake, rejected.withColumn("reason", reason), run_ts)
    count = entered.count()
    if count:
        lake.append(REGISTRY, stamp(entered, "run_ts", run_ts))
    return count


def hospital_ingested(lake: Lakehouse, hospital_id: str) -> bool:
    """Whether a recorded file held this hospital first."""
    registry = lake.read_or_empty(REGISTRY, REGISTRY_SCHEMA)
    return not registry.filter(F.col("hospital_id") == hospital_id).isEmpty()


def _sources_of_run(lake: Lakehouse, run_ts: datetime | Column) -> DataFrame:
    mark = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return lake.read(REGISTRY).filter(F.col("run_ts") == mark).select("source_id").distinct()


def rows_of_run(lake: Lakehouse, rows: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """Rows from the sources that a run ingested; partitions of others are pruned."""
    return rows.join(_sources_of_run(lake, run_ts), "source_id", "left_semi")


def bronze_of_run(lake: Lakehouse, run_ts: datetime | Column) -> DataFrame:
    """A run's charges, wherever they lie."""
    return _charges_among(bronze_rows(lake, _sources_of_run(lake, run_ts)))


@releasing
def compact(lake: Lakehouse) -> int:
    """Move recorded files from their own partitions into those of hospitals and months; returns how many."""
    return compact_bronze(lake, lake.read_or_empty(REGISTRY, REGISTRY_SCHEMA))


@releasing
def keep_unknown_fields(lake: Lakehouse, run_ts: datetime | Column) -> None:
    """Store the undeclared fields of a run's JSON files with their values, as JSON text, in place of what was stored.

    The files are read once more, in splits. ``unknown_fields`` reports them.
    """
    mark = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    files = lake.read(REGISTRY).filter((F.col("run_ts") == mark) & F.col("source_path").rlike(ENDINGS["json"]))
    rows = files.select("source_path").distinct().toLocalIterator()
    while batch := [row.source_path for row in islice(rows, FILES_PER_BATCH)]:
        values = drift.unknown_values(lake.spark, batch)
        lake.overwrite_partitions(UNKNOWN_VALUES, values.select("source_id", "field", F.to_json("value").alias("value")), ["source_id"])


def unknown_fields(lake: Lakehouse) -> DataFrame:
    """Undeclared fields of the stored files: source, field, occurrences, type."""
    stored = lake.read_or_empty(UNKNOWN_VALUES, "source_id string, field string, value string")
    return drift.unknown_fields(stored.withColumn("value", F.parse_json("value")), "source_id")


@releasing
def refine(lake: Lakehouse, run_ts: datetime | Column, mode: str = "strict") -> None:
    """Clean and enrich a run's bronze rows into silver. Rows of different files are never duplicates.

    A repeated run also removes the rows of sources that now leave none.
    """
    cleaned = CLEANERS[mode](bronze_of_run(lake, run_ts))
    # Gathered by file before the columns of silver are added, so that the shuffle is of clean rows.
    silver = enrich(cleaned.hint("rebalance", "source_id"), run_ts)
    if lake.exists("silver_charges"):
        before = rows_of_run(lake, lake.read("silver_charges"), run_ts).select("source_id")
        if not before.isEmpty():
            silver = staged(silver, "silver")
            gone = before.distinct().join(silver.select("source_id").distinct(), "source_id", "left_anti")
            lake.drop_partitions("silver_charges", gone)
    lake.overwrite_partitions("silver_charges", silver, ["source_id"])


@releasing
def score_run(lake: Lakehouse, run_ts: datetime | Column) -> None:
    """Rank and score a run's silver rows among themselves and store them under their published columns."""
    silver = rows_of_run(lake, lake.read("silver_charges"), run_ts)
    if silver.isEmpty():
        return
    scored = score(silver).select("source_id", *schemas.SCORED_SILVER)
    lake.overwrite_partitions("scored_silver", scored.hint("rebalance", "source_id"), ["source_id"])


@releasing
def build_gold(lake: Lakehouse, silver: DataFrame, run_ts: datetime | Column) -> None:
    """Add new members to the dimensions, then the run's facts."""
    for table, (schema, additions) in KEYED_DIMENSIONS.items():
        lake.append(table, additions(silver, lake.read_or_empty(table, schema)))
        quality.require_unique(lake.read(table), [schema.split(",")[1].split()[0]], table)
    for table, columns in ATTRIBUTE_DIMENSIONS.items():
        existing = lake.read(table) if lake.exists(table) else None
        lake.append(table, dimensions.attribute_additions(silver, existing, columns))
    stamped = stamp(silver, "gold_ingestion_ts", run_ts)
    facts = dimensions.fact_charges(stamped, lake.read("dim_payer"), lake.read("dim_plan"))
    mark = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    stated = history.states(silver, "hospital_id", "last_updated_on", schemas.DIM_HOSPITAL[1:]).withColumn("run_ts", mark)
    lake.overwrite_partitions(HOSPITAL_STATES, stated, ["run_ts"])
    commit_partition(lake, FACTS, facts, FACT_PARTITION, mark)


def hospital_history(lake: Lakehouse) -> DataFrame:
    """Versions of each hospital's attributes with the dates between which they hold, from all runs."""
    stated = lake.read(HOSPITAL_STATES).select("hospital_id", "last_updated_on", "state.*")
    return history.validity_intervals(
        history.states(stated, "hospital_id", "last_updated_on", schemas.DIM_HOSPITAL[1:]), "hospital_id", "last_updated_on")


def run_all(
    lake: Lakehouse,
    paths: str | Sequence[str],
    run_ts: datetime | Column,
    target: Target | None = None,
    mode: str = "strict",
    known_ids: Mapping[str, str] | DataFrame = KNOWN_HOSPITAL_IDS,
) -> int:
    """Ingest, refine, score, model and, with a target, export. Returns the number of files ingested."""
    files = ingest(lake, paths, run_ts, known_ids=known_ids)
    if files:
        refine(lake, run_ts, mode)
        score_run(lake, run_ts)
        build_gold(lake, rows_of_run(lake, lake.read("silver_charges"), run_ts), run_ts)
    if target is not None:
        export_gold(lake, target)
    return files
