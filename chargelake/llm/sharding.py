"""Shards by fixed virtual slots.

A row's id decides its slot, one of a few thousand whose number never changes. Bytes and rows are summed per slot, and
a versioned map assigns slots to shards. Growing or rebalancing edits the map: a few slots change their shard and all
other rows stay where they are. The map's size depends on the number of slots only. Versions are stored one beside the other
and never overwritten, so rows are placed by the latest or by any earlier one.

A NULL text counts as empty. Rows with a NULL id are dealt by their text, so that they don't meet in one slot; equal
rows share a slot. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from chargelake.staging import staged

SLOTS = 4096
ROW_BYTES = 8
PIECES = 64


def virtual_slot(id_col: Column, text: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(id_col.cast("string"), text)), F.lit(slots))


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(id, size, text_crc32, virtual_slot, piece) per row; ``piece`` splits a slot evenly, whatever its size."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        virtual_slot(F.col(id_col), text, slots).alias("virtual_slot"),
    ).withColumn("piece", F.monotonically_increasing_id() % PIECES)


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows of every slot, empty ones included."""
    held = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    every = rows.sparkSession.range(slots).withColumnRenamed("id", "virtual_slot")
    return every.join(held, "virtual_slot", "left").na.fill(0)


def balanced_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map (version, virtual_slot, shard): largest slot first, to the shard with the fewest bytes.

    Folds over one array of all slots, whose number is fixed. Ties go to the smaller slot and the
    smaller shard.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot")))
    start = F.struct(
        F.array(*[F.lit(0).cast("bigint")] * shards).alias("loads"),
        F.array().cast("array<struct<virtual_slot:bigint,shard:int>>").alias("placed"))

    def step(seen: Column, slot: Column) -> Column:
        least = F.array_position(seen["loads"], F.array_min(seen["loads"]))
        loads = F.transform(seen["loads"], lambda load, i: F.when(i == least - 1, load - slot["less"]).otherwise(load))
        place = F.struct(slot["virtual_slot"].alias("virtual_slot"), (least - 1).cast("int").alias("shard"))
        return F.struct(loads.alias("loads"), F.concat(seen["placed"], F.array(place)).alias("placed"))

    placed = sizes.agg(ordered.alias("slots")).select(F.aggregate("slots", start, step, lambda seen: seen["placed"]).alias("placed"))
    return placed.select(F.lit(1).alias("version"), F.inline("placed"))


def loads(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """Bytes per shard, empty shards included."""
    every = slot_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    held = slot_map.join(sizes, "virtual_slot").groupBy("shard").agg(F.sum("bytes").alias("load"))
    return every.join(held, "shard", "left").select("shard", F.coalesce("load", F.lit(0)).cast("bigint").alias("load"))


def rebalanced_map(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version: shards above their fair share give up slots, which fill the ones below it.

    ``shards`` may be more than before. Each overfull shard keeps its largest slots up to the mean and gives the rest;
    only given slots move, largest first, each to the shard with the fewest bytes then. Slots that have no bytes stay.
    """
    held = slot_map.join(sizes, "virtual_slot").select("version", "virtual_slot", "shard", "bytes")
    inside = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    fair = F.ceil(F.sum("bytes").over(Window.partitionBy(F.lit(0))) / shards)  # one row per slot
    marked = held.withColumn("given", (F.sum("bytes").over(inside) > fair) & (F.col("bytes") > 0))
    kept = marked.filter("NOT given")
    held_now = loads(kept.select("virtual_slot", "shard"), sizes, shards).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("shard", "load"))), lambda s: s["load"]).alias("loads"))
    given = marked.filter("given").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot"))).alias("slots"))

    def step(seen: Column, slot: Column) -> Column:
        least = F.array_position(seen["loads"], F.array_min(seen["loads"]))
        now = F.transform(seen["loads"], lambda load, i: F.when(i == least - 1, load - slot["less"]).otherwise(load))
        place = F.struct(slot["virtual_slot"].alias("virtual_slot"), (least - 1).cast("int").alias("shard"))
        return F.struct(now.alias("loads"), F.concat(seen["placed"], F.array(place)).alias("placed"))

    start = F.struct("loads", F.array().cast("array<struct<virtual_slot:bigint,shard:int>>").alias("placed"))
    moved = held_now.join(F.broadcast(given)).select(F.aggregate("slots", start, step, lambda seen: seen["placed"]).alias("placed"))
    version = slot_map.agg((F.max("version") + 1).alias("version"))
    edited = kept.select("virtual_slot", "shard").unionAll(moved.select(F.inline("placed")))
    return version.join(F.broadcast(edited)).select("version", "virtual_slot", "shard")


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Rows are numbered within a piece of a virtual slot; what lies before the piece in its shard comes from the counts
    per piece, a table as large as slots times pieces at most.
    """
    counts = rows.groupBy("virtual_slot", "piece").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot").select(
        "virtual_slot", "piece", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("virtual_slot", "piece").orderBy("id", "text_crc32", "size")
    numbered = rows.withColumn("within", F.row_number().over(inside) - 1)
    found = numbered.join(F.broadcast(staged(starts, "starts")), ["virtual_slot", "piece"])
    return found.select("id", "size", "text_crc32", "virtual_slot", "shard", (F.col("start") + F.col("within")).alias("slot"))


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The greatest version that is stored whole."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    named = (status.getPath() for status in files.listStatus(folder))
    whole = [p.getName() for p in named if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max((int(name.removeprefix("version=")) for name in whole if name.startswith("version=")), default=None)


def save_map(slot_map: DataFrame, path: str) -> int:
    """Store a map under the version it has; two editors of one version cannot both succeed.

    What a failed write left of a version is never read; it has to be deleted before that version can be stored.
    """
    version = slot_map.agg(F.max("version")).first()[0]
    slot_map.select("virtual_slot", "shard").coalesce(1).write.parquet(f"{path}/version={version}")
    return version


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(version, virtual_slot, shard) of a stored version, the latest unless one is named."""
    version = latest_version(spark, path) if version is None else version
    held = spark.read.schema("virtual_slot bigint, shard int").parquet(f"{path}/version={version}")
    return held.select(F.lit(version).alias("version"), "virtual_slot", "shard")


def edit_map(rows: DataFrame, path: str, shards: int, slots: int = SLOTS) -> DataFrame:
    """Store the next version for these slotted rows and return it: the first map, or the held one rebalanced."""
    spark, sizes = rows.sparkSession, staged(slot_sizes(rows, slots), "slot_sizes")
    held = latest_version(spark, path)
    edited = balanced_map(sizes, shards) if held is None else rebalanced_map(load_map(spark, path, held), sizes, shards)
    return load_map(spark, path, save_map(edited, path))


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """Rows with their shard and place, and the first version of the map, both stored."""
    rows = staged(slotted(docs, id_col, text_col, slots), "slotted")
    slot_map = staged(balanced_map(slot_sizes(rows, slots), shards), "slot_map")
    return placed(rows, slot_map), slot_map
