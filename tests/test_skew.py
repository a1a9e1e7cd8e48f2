"""Joins and ranks when one key, or one exact row, makes up most of the data."""

import pytest
from pyspark.sql import Window, functions as F

from chargelake.operators import score
from chargelake.operators.lookup import lookup_join
from chargelake.operators.ordering import running_total


@pytest.fixture(scope="module")
def skewed(spark):
    """60 % exact copies of one row, 10 % NULL keys, the rest spread over 400 keys, some unknown."""
    n = F.col("id")
    key = F.when(n % 10 < 6, "hot").when(n % 10 < 7, None).otherwise(F.concat(F.lit("k"), (n % 401).cast("string")))
    part = F.when(n % 10 < 6, 1).otherwise(n % 3).cast("int")
    return spark.range(20_000, numPartitions=6).select(key.alias("name"), part.alias("part"))


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("known", [True, False])
@pytest.mark.parametrize("size", [0, 1 << 20])
def test_lookup_join_equals_plain_join(spark, skewed, null_safe, known, size):
    lookup = (
        skewed.filter("name IS NULL OR name < 'k3'" + " OR name = 'hot'" * known).groupBy("name", "part")
        .agg(F.count(F.lit(1)).alias("n")).withColumn("label", F.concat(F.coalesce("name", F.lit("?")), F.lit("!")))
    )
    got = lookup_join(skewed, lookup, ["name", "part"], null_safe, broadcast_bytes=size, heavy_keys=3)
    d, k = skewed.alias("d"), lookup.alias("k")
    same = F.col("d.name").eqNullSafe(F.col("k.name")) if null_safe else F.col("d.name") == F.col("k.name")
    want = d.join(k, same & (F.col("d.part") == F.col("k.part")), "left").select("d.*", "k.n", "k.label")
    assert got.columns == ["name", "part", "n", "label"]
    assert rows(got) == rows(want)


def rows_per_task(df):
    """Uses the joined column too, or the optimizer would leave the join out."""
    counted = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.sum("n"))
    return [row.n for row in counted.collect()]


@pytest.mark.parametrize("known", [True, False])
def test_hot_copies_do_not_meet_in_one_task(spark, skewed, known):
    """The shuffle of the detail spreads the hot row over as many tasks as it came from, also if the lookup lacks it."""
    lookup = skewed.filter("name <> 'hot'" if not known else "true").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(skewed, lookup, ["name"], broadcast_bytes=0, heavy_keys=3)
        per_task = rows_per_task(joined)
        plain = rows_per_task(skewed.join(lookup, "name", "left"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert max(plain) >= 12_000
    assert max(per_task) <= 8_000


def test_running_total_of_one_group_over_many_slices(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 5 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 35).cast("string"))).alias("g"),
        F.when(F.col("id") > 0, F.col("id") * 7919 % 10007).alias("o"), (F.col("id") % 4 + 1).alias("v"),
    )
    got = running_total(df, ["g"], ["o"], "v", "total")
    want = df.withColumn("total", F.sum("v").over(Window.partitionBy("g").orderBy("o")))
    assert rows(got) == rows(want)


def test_running_total_without_groups_or_rows(spark):
    df = spark.range(1000).select("id", F.lit(1).cast("bigint").alias("one"))
    assert [row.n for row in running_total(df, [], ["id"], "one", "n").orderBy("id").collect()] == list(range(1, 1001))
    assert running_total(df.limit(0), [], ["id"], "one", "n").count() == 0


def test_score_is_the_same_beyond_the_broadcast_limit(spark, monkeypatch):
    n = F.col("id")
    charges = spark.range(6000).select(
        n, F.when(n % 3 > 0, "COMMON").when(n % 50 > 0, F.concat(F.lit("S"), (n % 40).cast("string"))).alias("service_description"),
        F.when(n % 17 > 0, (n * 31 % 997) / 10).alias("standard_charge_dollar"),
        F.when(n % 4 > 0, F.concat(F.lit("P"), (n % 6).cast("string"))).alias("payer_name"),
        (n % 2 == 0).alias("has_brand_indicator"),
    )
    by_service = Window.partitionBy("service_description")
    coverage = charges.filter("service_description IS NOT NULL").groupBy("service_description").agg(
        F.count_distinct("payer_name").alias("covered"))
    want = (
        charges.withColumn("r", F.rank().over(by_service.orderBy("standard_charge_dollar")))
        .join(coverage, "service_description", "left").withColumn("m", F.max("r").over(by_service))
        .select("id", "r", "m", "covered")
    )
    shown = ["id", "price_rank", "max_price_rank", "payer_coverage_count", "final_score"]
    small = score.score(charges).select(*shown)
    monkeypatch.setattr(score, "lookup_join", lambda *a, **k: lookup_join(*a, **k, broadcast_bytes=0, heavy_keys=5))
    large = score.score(charges).select(*shown)
    assert rows(small) == rows(large)
    assert rows(small.drop("final_score")) == rows(want)
    assert rows(score.with_price_rank(charges).select("id", "price_rank")) == rows(want.select("id", "r"))


def test_no_slice_holds_a_service_or_a_tie(spark):
    """One service with 60 % of the rows and one of its prices with 30 % are spread like all others."""
    n = F.col("id")
    charges = spark.range(40_000).select(
        n, F.when(n % 10 < 6, "COMMON").otherwise(F.concat(F.lit("S"), (n % 90).cast("string"))).alias("service_description"),
        F.when(n % 10 < 3, 5.0).when(n % 13 == 0, float("nan")).when(n % 11 > 0, (n * 31 % 997) / 10).alias("standard_charge_dollar"),
    )
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # so little data would else be one slice
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        sliced = score.sliced_by_price(charges)
        sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
        ranked = rows(score.with_price_rank(charges).select("id", "price_rank"))
    finally:
        spark.conf.set(coalesce, before)
    assert len(sizes) >= 6 and max(sizes) <= 1.6 * 40_000 / len(sizes)
    by_service = Window.partitionBy("service_description").orderBy("standard_charge_dollar")
    want = charges.withColumn("r", F.rank().over(by_service)).select("id", "r")
    assert ranked == rows(want)


def test_charges_are_not_sent_to_be_ranked(spark):
    """Counts of prices are sent and sorted; the charges themselves meet their ranks where they lie."""
    n = F.col("id")
    charges = spark.range(2000).select(
        n, F.concat(F.lit("S"), (n % 9).cast("string")).alias("service_description"), (n * 31 % 97 / 10).alias("standard_charge_dollar"),
        (n % 4).cast("string").alias("payer_name"), (n % 2 == 0).alias("has_brand_indicator"))
    for result in (score.with_price_rank(charges), score.score(charges)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Window" not in plan


def test_equal_prices_share_a_rank_whatever_their_form(spark):
    data = [("a", "S", 0.0), ("b", "S", -0.0), ("c", "S", float("nan")), ("d", "S", float("nan")), ("e", "S", None), ("f", "S", 1.0), ("g", None, 1.0), ("h", None, 1.0)]
    charges = spark.createDataFrame(data, "id string, service_description string, standard_charge_dollar double")
    got = {row.id: row.price_rank for row in score.with_price_rank(charges).collect()}
    assert got == {"e": 1, "a": 2, "b": 2, "f": 4, "c": 5, "d": 5, "g": 1, "h": 1}
