"""Ordered running totals without a sort of a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from chargelake.operators.lookup import same_key
from chargelake.staging import staged


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over this row and all before it, in ``order`` within ``by``.

    ``by`` and ``order`` together must identify a row. Rows are cut into contiguous slices by sampled
    ranges, so a large group spans many slices. The slice numbers are written down before they are used
    twice. Each slice sums its own rows and adds what earlier slices hold of the group; only the first
    group of a slice can have earlier rows, so the broadcast carry has fewer rows than there are slices.
    """
    keys = [*by, *order]
    sliced = staged(df.repartitionByRange(*keys).withColumn("_slice", F.spark_partition_id()), "slices")

    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        sliced.groupBy("_slice", *by).agg(F.sum(value).alias("_held"))
        .select("_slice", *by, F.sum("_held").over(earlier).alias("_carry"))
        .filter("_carry IS NOT NULL")
    )

    inside = Window.partitionBy("_slice", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumn("_local", F.sum(value).over(inside))
    left, right = local.alias("l"), F.broadcast(carry.alias("c"))
    match_on = ["_slice", *by]
    matches = same_key([F.col(f"l.{n}") for n in match_on], [F.col(f"c.{n}") for n in match_on], True)
    total = F.col("l._local") + F.coalesce("c._carry", F.lit(0))
    return left.join(right, matches, "left").select(
        *[F.col(f"l.`{column}`") for column in df.columns], total.cast("bigint").alias(name)
    )
