"""Benchmark decontamination with a hash set of the benchmark's normalised word windows.

Words are runs of 0-9, a-z (after folding A-Z) and any non-ASCII character. A window is ``size`` consecutive words of
an item, or all words of a shorter item. Every window of each document is hashed and looked up; a hit is confirmed
word by word, so hash collisions do no harm.

NULL and empty texts have no words and are never contaminated. Repeated rows get equal results, one each. A NULL item
id marks words but is not listed as an item. Only id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chargelake.llm.common import ascii_lower, row_key
from chargelake.staging import fits_broadcast, staged

# Fixed value: what separates words, after folding.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def codes_of(words: Column) -> Column:
    """Hash of each word; a window's hash is taken over these, so that no word is hashed once per window."""
    return F.transform(words, lambda word: F.xxhash64(word))


def windows_of(codes: Column, size: int) -> Column:
    """Hash of each run of ``size`` words, by its first word."""
    starts = F.sequence(F.lit(1), F.size(codes) - size + 1)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(codes, i, F.lit(size))))
    return F.when(F.size(codes) >= size, hashes)


def windows_with_words(codes: Column, words: Column, size: int) -> Column:
    """Hash and words of each run of ``size`` words, by its first word."""
    starts = F.sequence(F.lit(1), F.size(codes) - size + 1)
    runs = F.transform(starts, lambda i: F.struct(
        F.xxhash64(F.slice(codes, i, F.lit(size))).alias("hash"), F.slice(words, i, F.lit(size)).alias("own")))
    return F.when(F.size(codes) >= size, runs)


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW_WORDS) -> DataFrame:
    """(item, hash, words): all distinct windows of the items."""
    worded = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("all")).filter(F.size("all") > 0)
    length = F.least(F.size("all"), F.lit(size))
    runs = F.transform(F.sequence(F.lit(1), F.size("all") - length + 1), lambda i: F.slice(F.col("all"), i, length))
    return worded.select("item", F.explode(runs).alias("words")).distinct().select("item", F.xxhash64(codes_of(F.col("words"))).alias("hash"), "words")


def find_hits(keyed: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, places, items) of each text that holds a window: its hit words' places and the items' ids.

    ``keyed`` has ``key`` and ``text``. The windows are broadcast while they are measured to be small; beyond that
    they meet the documents' windows in a shuffle, each of which carries its own words and not its text's.
    """
    known = windows.groupBy("hash", "words").agg(F.collect_set("item").alias("items"))
    known = staged(known.withColumn("size", F.size("words")), "benchmark")
    sizes = sorted(row["size"] for row in known.select("size").distinct().collect())  # at most the window's words
    if not sizes:
        return keyed.select("key", F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("items")).limit(0)
    slim = known.select("hash", F.col("words").alias("window"), "size")
    small = fits_broadcast(slim)
    slim = F.broadcast(slim) if small else slim
    worded = keyed.select("key", words_of(F.col("text")).alias("words"))
    worded = worded.select("key", "words", codes_of(F.col("words")).alias("codes"))
    hits = None
    for size in sizes:
        # The outer form keeps Spark from evaluating the windows once more in an inferred filter.
        if small:
            scanned = worded.select("key", "words", F.posexplode_outer(windows_of(F.col("codes"), size)).alias("pos", "hash"))
            own = F.slice("words", F.col("pos") + 1, F.col("size"))
        else:
            runs = windows_with_words(F.col("codes"), F.col("words"), size)
            scanned = worded.select("key", F.posexplode_outer(runs).alias("pos", "run")).select("key", "pos", "run.hash", "run.own")
            own = F.col("own")
        met = scanned.join(slim.filter(F.col("size") == size), "hash").filter(own == F.col("window"))
        part = met.select("key", "pos", "size", "hash", "window")
        hits = part if hits is None else hits.unionAll(part)
    hits = staged(hits, "hits")
    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("pos"), F.col("pos") + F.col("size") - 1))))
    places = hits.groupBy("key").agg(covered.alias("places"))
    named = (
        hits.select("key", "hash", "window").distinct()
        .join(known.select("hash", F.col("words").alias("window"), "items"), ["hash", "window"])
        .select("key", F.explode("items").alias("item"))
        .groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return places.join(named, "key", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_WORDS,
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, number of words, places of hit words (from 0, unsorted), ids of the items found."""
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    found = find_hits(keyed, benchmark_windows(items, item_id_col, item_text_col, size))
    counted = keyed.select("id", "key", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    return counted.join(found, "key", "left").select(
        F.col("id").alias(id_col), "n_words",
        F.coalesce("places", F.array().cast("array<int>")).alias("places"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_WORDS,
) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of the benchmark, with all columns."""
    keyed = docs.select(F.struct("*").alias("row"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    texts = docs.select(F.col(text_col).alias("text"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    found = find_hits(texts, benchmark_windows(items, size=size)).select("key")
    return keyed.join(found, "key", "left_anti").select("row.*")


def without_passages(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_WORDS,
) -> DataFrame:
    """All rows; where a text holds windows of the benchmark, its hit words are removed.

    Such a text becomes its other words, separators reduced to single blanks; all other texts stay as they are.
    """
    keyed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    found = find_hits(keyed.select("key", "text"), benchmark_windows(items, size=size))
    plain = F.array_remove(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")
    left = F.filter(plain, lambda _, i: ~F.array_contains(F.col("places"), i))
    cleaned = keyed.join(found, "key", "left").select(
        "row", F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(left, " ")).alias("clean"))
    return cleaned.select(*[
        F.col("clean").alias(name) if name == text_col else F.col(f"row.`{name}`") for name in docs.columns
    ])
