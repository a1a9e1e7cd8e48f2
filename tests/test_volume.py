"""What the steps from charges to gold send and write."""

import glob

from pyspark.sql import functions as F

from chargelake import schemas
from chargelake.functions import rules
from chargelake.operators import clean, flatten
from chargelake.plans import queries
from chargelake.sinks.lakehouse import Lakehouse
from chargelake.staging import staged


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_shuffled_only_where_their_hash_is_repeated(spark):
    once = spark.range(500).select(F.col("id").cast("string").alias("code"), F.col("id").cast("double").alias("amount"))
    kept = clean.distinct_rows(once)
    assert "Exchange" not in plan_of(kept)
    assert kept.count() == 500


def test_distinct_rows_keeps_one_of_each(spark):
    rows = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), (None, None, None), (None, None, None), ("b", "c", 0.0), ("b", "c", -0.0),
            ("b", "c", float("nan")), ("b", "c", float("nan")), ("d", "e", 2.0)]
    df = spark.createDataFrame(rows, "x string, y string, z double")
    got, wanted = (sorted(map(str, out.collect())) for out in (clean.distinct_rows(df), df.dropDuplicates()))
    assert [row.replace("-0.0", "0.0") for row in got] == [row.replace("-0.0", "0.0") for row in wanted]
    assert len(got) == 6
    assert clean.distinct_rows(df.limit(0)).count() == 0


def test_many_repeated_rows_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(clean, "fits_broadcast", lambda df: False)
    df = spark.range(300).select((F.col("id") % 100).alias("a"), F.lit("x").alias("b"))
    assert clean.distinct_rows(df).count() == 100


def test_rows_are_compared_by_slices(spark, monkeypatch):
    monkeypatch.setattr(clean, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(clean, "ROWS_COMPARED", 100)
    labels, stage = [], clean.staged
    monkeypatch.setattr(clean, "staged", lambda df, label, *more: labels.append(label) or stage(df, label, *more))
    df = spark.range(350).select(F.when(F.col("id") % 100 > 0, F.col("id") % 100).alias("a"), F.lit("x").alias("b"))
    assert sorted(map(str, clean.distinct_rows(df).collect())) == sorted(map(str, df.dropDuplicates().collect()))
    assert labels.count("distinct") == 4


def test_items_are_spread_without_a_sort(spark):
    doc = spark.range(1).select(F.from_json(F.lit('{"license_information": {"license": "L"}}'), schemas.DOCUMENT).alias("d")).select("d.*")
    plan = plan_of(flatten.flatten_documents(staged(doc, "documents"), rebalance=True))
    assert "REBALANCE_PARTITIONS" in plan and "RoundRobinPartitioning" not in plan


def test_silver_is_stored_once(spark, monkeypatch):
    stored = []
    for module in (clean, queries):
        monkeypatch.setattr(module, "staged", lambda df, label, *more, stage=module.staged: stored.append(label) or stage(df, label, *more))
    queries._stored_silver(spark, "/root/testdata/sf0.001")
    assert "silver" not in stored and stored.count("rows") == 1


def test_shuffles_go_with_their_statement(spark):
    queries.QUERIES["count_rows"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_terms_are_searched_without_a_regular_expression(spark):
    text = spark.createDataFrame([("ct head",), ("a.b",), ("axb",), (None,)], "t string")
    found = text.select(rules.contains_any(F.col("t"), ("ct", "a.b")).alias("x"))
    assert "RLIKE" not in plan_of(found)
    assert [row.x for row in found.collect()] == [True, True, False, None]


def test_stored_tables_are_small(spark, tmp_path):
    lake = Lakehouse(spark, "volume", str(tmp_path / "lake"))
    rows = spark.range(10).select("id", F.lit("p").alias("part"))
    lake.replace("facts", rows, ["part"])
    lake.overwrite_partitions("facts", rows.withColumn("part", F.lit("q")), ["part"])
    lake.append("facts", rows.withColumn("part", F.lit("r")))
    written = glob.glob(f"{tmp_path}/lake/facts/*/*.parquet")
    assert len({file.split("/")[-2] for file in written}) == 3 and all(file.endswith(".zstd.parquet") for file in written)
    assert all(file.endswith(".zstd.parquet") for file in staged(rows, "rows", "zstd").inputFiles())
    spark.sql("DROP NAMESPACE volume CASCADE")


def test_columns_are_added_before_rows_are_stored(spark):
    """Rows that differ only in raw text stay apart; what is added is stored once, for repeated rows too."""
    charge = {"hospital_id": "1", "hospital_name": "h", "service_description": "mri", "gross_charge": 5.0, "min_charge": 1.0, "max_charge": 2.0,
              "standard_charge_dollar": 4.0, "plan_name": None, "last_updated_on": "2025-01-01"}
    rows = [{**charge, "payer_name": name} for name in (" a", "A", "A", "b")]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'double' if type(v) is float else 'string'}" for n, v in rows[0].items()))
    plain = clean.clean_strict(df)
    more = clean.clean_strict(df, then=lambda one: one.withColumn("kind", F.lower("payer_name")))
    assert sorted(r.payer_name for r in plain.collect()) == ["A", "A", "B"]
    assert plain.columns == df.columns and more.columns == [*df.columns, "kind"]
    assert sorted((r.payer_name, r.kind) for r in more.collect()) == [("A", "a"), ("A", "a"), ("B", "b")]
    once = clean.clean_strict(df.filter("payer_name = 'b'"), then=lambda one: one.withColumn("kind", F.lower("payer_name")))
    assert "lower" not in plan_of(once) and once.first().kind == "b"
