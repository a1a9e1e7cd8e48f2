"""Scans of hospital files, and the list of files not ingested yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chargelake import schemas
from chargelake.functions.columns import file_stem

ENDINGS = {"json": r"(?i)\.(json|jsonl|ndjson|txt)(\.(gz|bz2|zst))?$", "csv": r"(?i)\.csv(\.(gz|bz2|zst))?$"}


def scan_documents(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True, corrupt: str | None = None
) -> DataFrame:
    """Hospital documents: per file one object, or an array of them, over several lines.

    Such a file is read by one task; ``split_json`` reads large ones in many. Files that hold one document per line can
    be split; read those with ``multi_line=False``. ``corrupt`` names a column for the text of what does not parse.
    """
    schema = schemas.DOCUMENT + (f", {corrupt} string" if corrupt else "")
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    return (reader.option("columnNameOfCorruptRecord", corrupt) if corrupt else reader).json(paths)


def source_columns(path: Column) -> list[Column]:
    """Path, table-style name and an id of a file; the id differs for files of the same name."""
    name = file_stem(path)
    source_id = F.concat_ws("-", name, F.lower(F.hex(F.xxhash64(path))))
    return [path.alias("source_path"), name.alias("source_name"), source_id.alias("source_id")]


def with_source(df: DataFrame) -> DataFrame:
    """Add the file each row was read from, and its length. Directly on a file scan only."""
    return df.select("*", *source_columns(F.url_decode("_metadata.file_path")), F.col("_metadata.file_size").alias("length"))


def scan_csv(spark: SparkSession, paths: str | Sequence[str], corrupt: str | None = None, **options: str) -> DataFrame:
    """Wide CSV by header name, all columns as text. Files of one call must share their header;
    one that differs is an error, not a silent shift of columns. ``corrupt`` names a column for the text of lines
    that do not fit the header; their other columns hold what could be read."""
    reader = spark.read.option("header", True).option("enforceSchema", False).options(**options)
    if corrupt is None:
        return reader.csv(paths)
    names = reader.csv(paths).schema
    return reader.schema(names.add(corrupt, "string")).option("columnNameOfCorruptRecord", corrupt).csv(paths)


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def listed_columns(files: DataFrame, file_format: str | None = None) -> DataFrame:
    """Source columns and length of files read as binary, of one format or of all; contents are not read."""
    if file_format is not None:
        files = files.filter(F.col("path").rlike(ENDINGS[file_format]))
    return files.select(*source_columns(F.col("path")), "length")


def list_files(spark: SparkSession, paths: str | Sequence[str], file_format: str | None = None) -> DataFrame:
    return listed_columns(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths), file_format)


def files_to_ingest(listing: DataFrame, registry: DataFrame) -> DataFrame:
    """Files that were not ingested before: no known file has their path and length."""
    return listing.join(registry.select("source_path", "length"), ["source_path", "length"], "left_anti")


def conflicting_files(new: DataFrame, registry: DataFrame) -> DataFrame:
    """New files of a name that another file had, whatever its folder: ingested before, or new as well."""
    known = registry.select("source_name").distinct().withColumn("taken", F.lit(True))
    named = new.groupBy("source_name").agg(F.count(F.lit(1)).alias("files"))
    marked = new.join(named, "source_name").join(known, "source_name", "left")
    return marked.filter("taken OR files > 1").select(*new.columns)


def content_marks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(source_path, content): what tells the contents of text files apart, whatever their name.

    Files of equal marks have the same records, each up to a brace, in any order. Large files are read by many tasks;
    an empty file has no mark.
    """
    records = spark.read.option("lineSep", "}").text(list(paths))
    summed = F.sum(F.xxhash64("value").cast("decimal(20,0)")).cast("string")
    marks = records.groupBy(F.url_decode("_metadata.file_path").alias("source_path")).agg(F.count(F.lit(1)).alias("records"), summed.alias("sum"))
    return marks.select("source_path", F.concat_ws("-", "records", "sum").alias("content"))


def redelivered_files(new: DataFrame, known: DataFrame) -> DataFrame:
    """New files whose content a known file has, or a new file of a lesser path; both tables have ``content``."""
    taken = known.select("content").distinct().withColumn("taken", F.lit(True))
    first = new.groupBy("content").agg(F.min("source_path").alias("first"))
    marked = new.join(first, "content").join(taken, "content", "left")
    return marked.filter("taken OR source_path <> first").select(*new.columns)
