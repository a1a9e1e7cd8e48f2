"""Validity intervals, as-of lookups, best plans, mergeable coverage, grouped CSV headers."""

from datetime import date

from pyspark.sql import functions as F

from chargelake.operators import flatten, history, score

D = [date(2020, 1, day) for day in range(1, 10)]


def test_intervals_neither_overlap_nor_leave_gaps(spark):
    rows = [("a", D[0], "x"), ("a", D[2], "x"), ("a", D[3], "y"), ("a", D[5], "x"), ("a", D[5], "z"), ("b", D[1], None), ("b", D[4], "q"), (None, D[0], "n"), ("c", None, "m")]
    stated = history.states(spark.createDataFrame(rows, "k string, d date, v string"), "k", "d", ["v"])
    found = history.validity_intervals(stated, "k", "d")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("a", "x", D[0], D[3]), ("a", "y", D[3], D[5]), ("a", "x", D[5], None), ("b", None, D[1], D[4]), ("b", "q", D[4], None)], key=str)
    facts = spark.createDataFrame([("a", D[0]), ("a", D[1]), ("a", D[3]), ("a", D[8]), ("b", D[0]), ("b", D[1]), ("b", D[4]), ("z", D[0]), ("a", None), (None, D[0])], "k string, d date")
    got = {(row.k, row.d): row.v for row in history.as_of(facts, found, "k", "d").collect()}
    assert got == {
        ("a", D[0]): "x", ("a", D[1]): "x", ("a", D[3]): "y", ("a", D[8]): "x", ("b", D[0]): None, ("b", D[1]): None,
        ("b", D[4]): "q", ("z", D[0]): None, ("a", None): None, (None, D[0]): None}


def scored(spark, rows):
    return spark.createDataFrame(rows, "service_description string, payer_name string, plan_name string, hospital_id string, standard_charge_dollar double, final_score double")


def test_best_plans_have_a_total_order(spark):
    rows = [
        ("s", "P", "b", "1", 5.0, 0.5), ("s", "P", "a", "1", 5.0, 0.5), ("s", "P", None, "1", 5.0, 0.5), ("s", "Q", "a", "1", 4.0, 0.5),
        ("s", "Q", "a", "2", 9.0, 0.1), ("s", None, "z", "3", 1.0, 0.9), ("s", "N", "n", "3", 1.0, None), ("t", None, None, None, None, 0.0)]
    found = score.best_plans(scored(spark, rows), 4).orderBy("service_description", "place").collect()
    assert [(r.service_description, r.place, r.payer_name, r.plan_name, r.final_score) for r in found] == [
        ("s", 1, None, "z", 0.9), ("s", 2, "Q", "a", 0.5), ("s", 3, "P", None, 0.5), ("s", 4, "P", "a", 0.5), ("t", 1, None, None, 0.0)]


def test_a_service_of_most_rows_stays_below_its_task_share(spark):
    """60 % of the charges and 40,000 plans in one service: charges meet by plan, plans by slices of their hash."""
    many = spark.range(100_000).select(
        F.when(F.col("id") % 5 < 3, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("service_description"),
        F.concat(F.lit("P"), F.col("id") % 40_000).alias("payer_name"), F.lit("p").alias("plan_name"), F.lit("1").alias("hospital_id"),
        F.col("id").cast("double").alias("standard_charge_dollar"), (F.xxhash64("id") % 1000 / 1000.0).alias("final_score"))
    found = score.best_plans(many, 3)
    assert found.filter("service_description = 'hot'").count() == 3
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    part = F.pmod(F.xxhash64("payer_name", "plan_name"), F.lit(64))
    plans = many.select("service_description", "payer_name", "plan_name", part.alias("part")).distinct()
    largest = plans.groupBy("service_description", "part").count().agg(F.max("count")).first()[0]
    assert largest < plans.count() / 40


def test_merged_bitmaps_count_each_payer_once(spark):
    def charges(*rows):
        return spark.createDataFrame(rows, "service_description string, payer_name string, payer_id bigint")

    first = score.coverage_bitmaps(charges(("s", "a", 1), ("s", "b", 40_000), ("t", None, 7)))
    second = score.coverage_bitmaps(charges(("s", "a", 1), ("s", "c", 40_001), ("s", None, 7)))
    found = score.merged_coverage(first.unionByName(second)).collect()
    assert {row.service_description: row.payer_coverage_count for row in found} == {"s": 3, "t": 0}


def test_groups_of_a_wide_header(spark):
    names = [
        "description", "code | 1", "code | 1 | type", "Code|2", "code | 2 | type", "code | 10", "standard_charge | gross", "payer_name", "plan_name",
        "standard_charge | negotiated_dollar", "standard_charge | A | x | negotiated_dollar", "standard_charge | A | x | methodology",
        "estimated_amount | B | y", "additional_payer_notes | B | y", "source_id"]
    rows = [
        ("all", "c1", "CPT", "c2", "NDC", "c10", "5", "L", "l", "1.5", "7", "fee", "8", "n", "f"),
        ("bare", None, "CPT", None, None, None, "x", None, None, None, None, None, None, None, "f")]
    wide = spark.createDataFrame(rows, ", ".join(f"`{name}` string" for name in names))
    found = flatten.align_csv_groups(wide, ["source_id"])
    assert found.columns[0] == "source_id" and len(found.columns) == len(set(found.columns)) == 28
    got = {(r.service_description, r.code, r.code_type, r.payer_name, r.plan_name, r.standard_charge_dollar, r.methodology, r.additional_payer_notes) for r in found.collect()}
    payers = [("L", "l", 1.5, None, None), ("A", "x", 7.0, "fee", None), ("B", "y", 8.0, None, "n")]
    codes = [("c1", "CPT"), ("c2", "NDC"), ("c10", None)]
    assert got == {("all", *code, *payer) for code in codes for payer in payers} | {("bare", None, None, None, None, None, None, None)}
    assert found.count() == 10


def test_a_header_without_groups_reads_as_before(spark):
    wide = spark.createDataFrame([("a", "9", "c", "1.5")], "`description` string, `provider_id` string, `code | 1` string, `standard_charge | negotiated_dollar` string")
    assert flatten.align_csv_groups(wide).collect() == flatten.align_csv(wide).collect()
