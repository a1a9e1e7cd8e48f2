"""Attributes over time: validity intervals, and the version that holds at a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from chargelake.operators.lookup import lookup_join
from chargelake.staging import staged


def states(rows: DataFrame, key: str, date: str, attributes: Sequence[str]) -> DataFrame:
    """What is stated of each key at each date; of several statements at one date the least counts, NULL first."""
    known = rows.filter(F.col(key).isNotNull() & F.col(date).isNotNull())
    return known.groupBy(key, date).agg(F.min(F.struct(*attributes)).alias("state"))


def validity_intervals(stated: DataFrame, key: str, date: str) -> DataFrame:
    """(key, attributes, valid_from, valid_to): runs of equal states, each until the next begins; the last is open.

    The intervals of a key neither overlap nor leave gaps. A window holds the dates of one key, not its rows.
    """
    order = Window.partitionBy(key).orderBy(date)
    before = F.lag("state").over(order)
    begins = stated.withColumn("_first", F.row_number().over(order) == 1).withColumn("_before", before)
    begins = begins.filter(F.col("_first") | ~F.col("state").eqNullSafe(F.col("_before")))
    return begins.select(key, "state.*", F.col(date).alias("valid_from"), F.lead(date).over(order).alias("valid_to"))


def as_of(facts: DataFrame, history: DataFrame, key: str, date: str) -> DataFrame:
    """Facts with the attributes that held at their date; NULL before the first version, or without a date.

    A key's versions are one row of the lookup, so no range join is needed.
    """
    attributes = [name for name in history.columns if name not in (key, "valid_from", "valid_to")]
    version = F.struct("valid_from", "valid_to", *attributes)
    versions = history.groupBy(key).agg(F.array_sort(F.collect_list(version)).alias("_versions"))
    found = lookup_join(facts, staged(versions, "versions"), [key])
    when = F.col(date)
    holds = F.filter("_versions", lambda v: (v["valid_from"] <= when) & (v["valid_to"].isNull() | (when < v["valid_to"])))
    return found.withColumn("_version", F.get(holds, F.lit(0))).select(*facts.columns, *[f"_version.{name}" for name in attributes])
