"""What several corpus operators share: row keys, ASCII folding, spans of matches, table access."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; all other characters stay as they are."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def row_key(*columns: Column) -> Column:
    """128 bits that tell rows of different content apart; NULL is a value. Equal rows share their key."""
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit("again"), *reversed(columns))
    return F.struct(first.alias("a"), second.alias("b"))


def spans_from(gaps: Column, found: Column, values: Column) -> Column:
    """Places of matches as array<start, end, value>, in code points, end exclusive.

    ``found`` holds a pattern's matches and ``gaps`` the texts around them, so their lengths give the places.
    ``values`` is handed on. Each should be a column of its own, as functions with lambdas evaluate what they use
    once per use.
    """
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    pairs = F.arrays_zip(
        F.slice(F.transform(gaps, F.length), F.lit(1), F.size(found)).alias("gap"),
        F.transform(found, F.length).alias("size"),
        values.alias("value"),
    )

    def step(seen: Column, pair: Column) -> Column:
        start = seen["at"] + pair["gap"]
        end = start + pair["size"]
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(seen["spans"], F.array(span)).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(F.size(found) > 0, F.aggregate(pairs, first, step, lambda seen: seen["spans"])).otherwise(none)


def replace_spans(text: Column, spans: Column, replacement: Column) -> Column:
    """``text`` with each of the sorted, disjoint ``spans`` (start, end) replaced."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(seen: Column, span: Column) -> Column:
        gap = F.substring(text, seen["at"] + 1, span["start"] - seen["at"])
        return F.struct(span["end"].alias("at"), F.concat(seen["out"], gap, replacement).alias("out"))

    rest = lambda seen: F.concat(seen["out"], F.substring(text, seen["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, first, step, rest)).otherwise(text)


def merged_spans(spans: Column) -> Column:
    """Overlapping or touching (start, end) spans joined into one; ``spans`` must be sorted by start."""
    kind = "array<struct<start:int,end:int>>"

    def step(seen: Column, span: Column) -> Column:
        last = F.element_at(seen, -1)
        one = F.struct(span["start"].alias("start"), span["end"].alias("end"))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        joins = (F.size(seen) > 0) & (span["start"] <= F.try_element_at(seen, F.lit(-1))["end"])
        grown = F.concat(F.slice(seen, F.lit(1), F.size(seen) - 1), F.array(wider))
        return F.when(joins, grown).otherwise(F.concat(seen, F.array(one)))

    return F.aggregate(spans, F.array().cast(kind), step)
