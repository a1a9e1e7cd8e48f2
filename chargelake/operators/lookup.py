"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from chargelake.staging import BROADCAST_BYTES, fits_broadcast

HEAVY_KEYS = 1000
_ROUTES = 1 << 20


def same_key(left: Sequence[Column], right: Sequence[Column], null_safe: bool) -> Column:
    pairs = zip(left, right, strict=True)
    return reduce(and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))


def new_members(candidates: DataFrame, known: DataFrame, on: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Candidates whose key is not known yet. Null-safe, a known NULL member is found again."""
    c, k = candidates.alias("c"), known.select(*on).alias("k")
    matches = same_key([F.col(f"c.{n}") for n in on], [F.col(f"k.{n}") for n in on], null_safe)
    return c.join(k, matches, "left_anti")


def lookup_join(
    detail: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    heavy_keys: int = HEAVY_KEYS,
) -> DataFrame:
    """Left join ``detail`` to a lookup whose key is unique, keeping every detail row once.

    A lookup measured below ``broadcast_bytes`` is broadcast and the detail is not shuffled. Beyond it,
    only the ``heavy_keys`` most frequent keys of the detail are broadcast, with their lookup row if there
    is one; any other key then holds at most one part in ``heavy_keys`` of the detail and meets its partner
    in a shuffle. Rows that have been served already, or can have no partner, are routed by their input
    partition, which spreads even exact copies and is the same again when a lost task is repeated.

    ``lookup`` should be cheap to read twice (a table, or staged).
    """
    keys = list(on)
    carried = [name for name in lookup.columns if name not in keys]
    wide = lookup.select(
        *[F.col(name).alias(f"_key_{name}") for name in keys],
        F.struct(*carried).alias("_hit"),
    )
    own_keys = [F.col(name) for name in keys]
    other_keys = [F.col(f"_key_{name}") for name in keys]
    matches = same_key(own_keys, other_keys, null_safe)

    if fits_broadcast(lookup, broadcast_bytes):
        joined = detail.join(F.broadcast(wide), matches, "left")
        return joined.select(*detail.columns, "_hit.*")

    counted = detail.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    frequent = counted.orderBy(F.desc("_rows")).limit(heavy_keys).select(*keys)
    # Whether or not the lookup knows it, a frequent key is settled here.
    heavy = frequent.join(wide, matches, "left").select(
        *[F.col(name).alias(f"_key_{name}") for name in keys], "_hit", F.lit(True).alias("_frequent")
    )

    served = detail.join(F.broadcast(heavy), matches, "left").select(
        *detail.columns, F.col("_hit").alias("_heavy_hit"), "_frequent"
    )
    done = F.isnotnull("_frequent")
    if not null_safe:
        done = reduce(lambda a, b: a | b, (column.isNull() for column in own_keys), done)
    by_key = F.pmod(F.xxhash64(*own_keys), F.lit(_ROUTES))
    routed = served.withColumn(
        "_route", F.when(done, -1 - F.spark_partition_id().cast("bigint")).otherwise(by_key)
    )
    partners = wide.withColumn("_partner_route", F.pmod(F.xxhash64(*other_keys), F.lit(_ROUTES)))
    joined = routed.join(partners, matches & (F.col("_route") == F.col("_partner_route")), "left")
    hit = F.coalesce("_heavy_hit", "_hit").alias("_hit")
    return joined.select(*detail.columns, hit).select(*detail.columns, "_hit.*")
