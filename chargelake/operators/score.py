"""Price ranks, payer coverage and the combined score of each charge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chargelake.operators.lookup import lookup_join, same_key
from chargelake.staging import staged

SERVICE = "service_description"
PRICE = "standard_charge_dollar"

# Weights of the score's parts.
WEIGHTS = {"score_price": 0.5, "score_coverage": 0.3, "score_brand": 0.2}


def sliced_by_price(rows: DataFrame) -> DataFrame:
    """Rows stored in slices of similar size, contiguous by service and price; add ``_slice``.

    The last key of the ranges is a row number, so neither a large service nor a common price nor copies of a row are
    bound to one slice. The slice numbers are written down before they are used twice.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(SERVICE, PRICE, "_row")
    return staged(numbered.drop("_row").withColumn("_slice", F.spark_partition_id()), "slices")


def price_ranks(charges: DataFrame) -> DataFrame:
    """Rank of each price within its service, cheapest first, NULL before all: service, price, ``price_rank``.

    One more than the number of charges below the price: those of the slice, and what earlier slices hold of the
    service. Only the first service of a slice can have earlier rows, so the broadcast carry has no more rows than
    slices. Charges are counted before they are sent; slices hold distinct prices.
    """
    sliced = sliced_by_price(charges.groupBy(SERVICE, PRICE).agg(F.count(F.lit(1)).alias("n")))
    earlier = Window.partitionBy(SERVICE).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    held = sliced.groupBy("_slice", SERVICE).agg(F.sum("n").alias("held"))
    carry = held.select("_slice", SERVICE, F.sum("held").over(earlier).alias("before")).filter("before IS NOT NULL")
    inside = Window.partitionBy("_slice", SERVICE).orderBy(PRICE).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("_below", F.sum("n").over(inside)).alias("s")
    matches = same_key([F.col("s._slice"), F.col(f"s.{SERVICE}")], [F.col("c._slice"), F.col(f"c.{SERVICE}")], True)
    rank = F.coalesce("s._below", F.lit(0)) + F.coalesce("c.before", F.lit(0)) + 1
    joined = local.join(F.broadcast(carry.alias("c")), matches, "left")
    return joined.select(f"s.{SERVICE}", f"s.{PRICE}", rank.alias("price_rank"))


def with_price_rank(charges: DataFrame) -> DataFrame:
    """Add ``price_rank``. The charges are read for the counts and again for the result, and should be stored."""
    return lookup_join(charges, staged(price_ranks(charges), "ranks"), [SERVICE, PRICE], null_safe=True)


def payer_coverage(charges: DataFrame, rsd: float | None = None) -> DataFrame:
    """Distinct payers per service; exact, or estimated within ``rsd`` when that is given."""
    payers = F.approx_count_distinct("payer_name", rsd) if rsd else F.count_distinct("payer_name")
    return charges.groupBy(SERVICE).agg(payers.alias("payer_coverage_count"))


def with_coverage(charges: DataFrame) -> DataFrame:
    return lookup_join(charges, staged(payer_coverage(charges), "coverage"), [SERVICE])


def service_facts(charges: DataFrame, ranks: DataFrame) -> DataFrame:
    """Per service: its greatest price rank and its coverage.

    Coverage is looked up by name, so charges without a service have none.
    """
    greatest = ranks.groupBy(SERVICE).agg(F.max("price_rank").alias("max_price_rank"))
    return greatest.join(payer_coverage(charges), SERVICE, "left")


def score(
    charges: DataFrame,
    weights: dict[str, float] = WEIGHTS,
    coverage_scope: str = "service",
) -> DataFrame:
    """Add ranks, coverage, partial scores and ``final_score`` to each charge.

    Coverage is measured against the best of its own service, which makes that part 1 for every service
    with a payer; ``coverage_scope="global"`` measures it against the best of all services.

    The charges are read for the ranks of prices, for coverage and for the result, and should be stored; they are not sorted.
    """
    ranks = staged(price_ranks(charges), "ranks")
    facts = staged(service_facts(charges, ranks), "services")
    ranked = lookup_join(charges, ranks, [SERVICE, PRICE], null_safe=True)
    described = lookup_join(ranked, facts, [SERVICE], null_safe=True)
    best = F.col("payer_coverage_count")
    if coverage_scope == "global":
        best = F.lit(facts.agg(F.max("payer_coverage_count")).first()[0]).cast("bigint")
    parts = described.withColumn("max_coverage", best).withColumns({
        "score_price": F.try_divide(F.col("max_price_rank") - F.col("price_rank"), F.col("max_price_rank")),
        "score_coverage": F.try_divide(F.col("payer_coverage_count"), F.col("max_coverage")),
        "score_brand": F.col("has_brand_indicator").cast("double"),
    })
    total = None
    for part, share in weights.items():
        weighted = F.col(part) * F.lit(share)
        total = weighted if total is None else total + weighted
    return parts.withColumn("final_score", total)


def best_plans(scored: DataFrame, k: int = 3, slices: int = 64) -> DataFrame:
    """The ``k`` best plans of each service: by score, then the lower price, then the names, NULL first.

    A plan stands for its best charge. Charges are combined per plan before they are sent, then the plans of a service
    per slice of their hash to its ``k`` best, then the slices; so a service of any share of the charges, or with any
    number of plans, is never in one task.
    """
    rank = F.struct((-F.col("final_score")).alias("order"), PRICE, "hospital_id")
    charges = scored.filter(F.col("final_score").isNotNull())
    plans = charges.groupBy(SERVICE, "payer_name", "plan_name").agg(F.min(rank).alias("best"))
    entry = F.struct("best.order", f"best.{PRICE}", "payer_name", "plan_name", "best.hospital_id")

    def first_of(entries: Column) -> Column:
        return F.slice(F.array_sort(entries, _null_first), 1, k).alias("entries")

    part = F.pmod(F.xxhash64("payer_name", "plan_name"), F.lit(slices)).alias("part")
    sliced = plans.groupBy(SERVICE, part).agg(first_of(F.collect_list(entry)))
    merged = sliced.groupBy(SERVICE).agg(first_of(F.flatten(F.collect_list("entries"))))
    placed = merged.select(SERVICE, F.posexplode("entries").alias("at", "plan"))
    return placed.select(
        SERVICE, (F.col("at") + 1).alias("place"), "plan.payer_name", "plan.plan_name", "plan.hospital_id",
        f"plan.{PRICE}", (-F.col("plan.order")).alias("final_score"))


def _null_first(left: Column, right: Column) -> Column:
    """Order of two entries by their fields, NULL before any value."""
    order = F.lit(0)
    for name in ("hospital_id", "plan_name", "payer_name", PRICE, "order"):
        a, b = left[name], right[name]
        order = (
            F.when(a.isNull() & b.isNotNull(), -1).when(a.isNotNull() & b.isNull(), 1)
            .when(a < b, -1).when(a > b, 1).otherwise(order))
    return order


def coverage_bitmaps(charges: DataFrame, payer_key: str = "payer_id", payer: str = "payer_name") -> DataFrame:
    """Which payers cover each service, as bitmaps over their keys: a row per service and range of keys.

    Bitmaps of deliveries are exact and can be merged, so a new delivery needs no look at the charges of earlier ones.
    Charges without a payer cover nothing; a service that has only such charges keeps an empty bitmap.
    """
    key = F.when(F.col(payer).isNotNull(), F.col(payer_key))
    position = F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("payers")
    return charges.groupBy(SERVICE, F.bitmap_bucket_number(key).alias("bucket")).agg(position)


def merged_coverage(bitmaps: DataFrame) -> DataFrame:
    """Number of payers of each service, from the bitmaps of any number of deliveries."""
    merged = bitmaps.groupBy(SERVICE, "bucket").agg(F.bitmap_or_agg("payers").alias("payers"))
    return merged.groupBy(SERVICE).agg(F.sum(F.bitmap_count("payers")).alias("payer_coverage_count"))
