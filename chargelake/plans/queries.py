"""One query per operator, over charges and documents derived from the order tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, wraps
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chargelake import fixtures, schemas
from chargelake.functions import columns
from chargelake.operators import clean, dimensions, enrich, flatten, history, quality, score
from chargelake.operators.lookup import new_members
from chargelake.plans import jobs
from chargelake.plans.oracles import EARLIER_TS, RUN_TS
from chargelake.session import free_shuffles, short_methods
from chargelake.sinks.export import FACTS, LEDGER, export_gold, exported
from chargelake.sinks.lakehouse import Lakehouse
from chargelake.sources import files, split_json, tables
from chargelake.staging import released, scratch_path, staged
from chargelake.streaming.pickup import start_pickup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STAMPS = ("silver_ingestion_ts", "gold_ingestion_ts", "high_ts")


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        short_methods(spark)
        free_shuffles(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _run_ts(local: bool = True) -> Column:
    """The fixed run time of all queries, without or with a time zone."""
    return F.lit(RUN_TS).cast("timestamp_ntz" if local else "timestamp")


def _without_zone(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in STAMPS if name in df.columns})


def _charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.charges(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(clean.clean_strict(_charges(spark, sf_dir)), _run_ts())


def _stored_silver(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Silver, or some columns of it, as a table for operators that read it more than once.

    Whole rows are enriched before cleaning stores them, and are not stored again.
    """
    if names:
        return staged(_silver(spark, sf_dir).select(*names), "silver")
    return clean.clean_strict(_charges(spark, sf_dir), then=partial(enrich.enrich, run_ts=_run_ts()))


SERVICE_KEY = ("hospital_id", "code", "service_description")
SCORE_INPUT = (*SERVICE_KEY, "payer_name", "plan_name", "standard_charge_dollar", "has_brand_indicator")


def _lake(spark: SparkSession, label: str) -> Lakehouse:
    return Lakehouse(spark, f"{label}_{uuid4().hex[:12]}", scratch_path(spark, label))


def _delivered(spark: SparkSession, sf_dir: str, *settings: str) -> list[str]:
    """Documents written as files, one folder per care setting."""
    folders = []
    with released(spark):
        docs = fixtures.documents(spark, sf_dir)
        for setting in settings:
            folder = scratch_path(spark, setting)
            fixtures.write_documents(docs.filter(F.col("setting") == setting), folder, packed=True)
            folders.append(folder)
    return folders


def _all_documents(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_path(spark, "delivered")
    with released(spark):
        fixtures.write_documents(fixtures.documents(spark, sf_dir), folder, packed=True)
    return folder


# Sources


@query
def scan_json_nested(spark, sf_dir):
    return flatten.flatten_documents(files.scan_documents(spark, _all_documents(spark, sf_dir)))


@query
def scan_json_split(spark, sf_dir):
    """All documents in one file, read by many tasks."""
    folder = scratch_path(spark, "one-file")
    with released(spark):
        fixtures.write_one_file(fixtures.documents(spark, sf_dir), folder)
    return flatten.flatten_documents(split_json.scan_split_documents(spark, folder))


@query
def scan_csv(spark, sf_dir):
    folder = scratch_path(spark, "csv")
    fixtures.write_csv(_charges(spark, sf_dir), folder)
    return flatten.align_csv(files.scan_csv(spark, folder))


@query
def scan_parquet(spark, sf_dir):
    folder = scratch_path(spark, "parquet")
    _charges(spark, sf_dir).write.parquet(folder)
    return files.scan_parquet(spark, folder)


@query
def scan_table(spark, sf_dir):
    lake = _lake(spark, "scan")
    lake.replace("charges", _charges(spark, sf_dir), ["care_setting"])
    return tables.scan_table(spark, lake.full_name("charges"))


def _stamped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with an ingestion time that differs below the second."""
    micros = F.unix_micros(F.col("l_shipdate").cast("timestamp")) + F.col("l_quantity").cast("bigint")
    lines = fixtures.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_partkey", F.timestamp_micros(micros).alias("gold_ingestion_ts"), "l_shipdate")


def _exported_lines(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Lines as a table whose first years have been exported."""
    lake = _lake(spark, "lines")
    lake.replace("lines", _stamped_lines(spark, sf_dir))
    exported = lake.read("lines").filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    lake.advance_watermark("lines", exported, "gold_ingestion_ts")
    return lake


@query
def incremental_scan(spark, sf_dir):
    pending = _exported_lines(spark, sf_dir).pending("lines", "gold_ingestion_ts")
    return _without_zone(pending.drop("l_shipdate"))


@query
def watermark_advance(spark, sf_dir):
    lake = _exported_lines(spark, sf_dir)
    lake.advance_watermark("lines", lake.pending("lines", "gold_ingestion_ts"), "gold_ingestion_ts")
    return _without_zone(lake.read("etl_watermark"))


def _with_row_counts(lake: Lakehouse, listing: DataFrame) -> DataFrame:
    counts = None
    for table in lake.spark.catalog.listTables(lake.namespace):
        one = lake.read(table.name).agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(table.name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.union(one)
    return listing.join(counts, "table_name")


@query
def catalog_listing(spark, sf_dir):
    lake = _lake(spark, "listing")
    lake.replace("charges", _charges(spark, sf_dir))
    lake.replace("silver", enrich.enrich(clean.clean_strict(lake.read("charges")), _run_ts()))
    lake.replace("dim_plan", lake.read("silver").select("plan_name").dropna().distinct())
    return _with_row_counts(lake, tables.describe_tables(spark, lake.namespace))


@query
def adhoc_code_lookup(spark, sf_dir):
    shown = ["plan_name", "code", "gross_charge", "discounted_cash", "standard_charge_percentage"]
    return tables.lookup_equal(_charges(spark, sf_dir), "code", "17", shown)


@query
def code_lookup_skipping(spark, sf_dir):
    """The same lookup on a table sorted by code, with Bloom filters."""
    lake = _lake(spark, "indexed")
    lake.replace_indexed("charges", _charges(spark, sf_dir), "code", distinct=10_000)
    shown = ["plan_name", "code", "gross_charge", "discounted_cash", "standard_charge_percentage"]
    return tables.lookup_equal(lake.read("charges"), "code", "17", shown)


@query
def distinct_services(spark, sf_dir):
    return tables.distinct_values(_charges(spark, sf_dir), "service_description")


@query
def ingest_new_only(spark, sf_dir):
    first, second = _delivered(spark, sf_dir, "inpatient", "outpatient")
    lake = _lake(spark, "pickup")
    known_ids = _suppliers_by_name(spark, sf_dir)
    jobs.ingest(lake, first, F.lit("2025-02-01").cast("timestamp"), known_ids=known_ids)
    jobs.ingest(lake, [first, second], _run_ts(local=False), known_ids=known_ids)
    return jobs.rows_of_run(lake, jobs.bronze_charges(lake), _run_ts(local=False)).drop("source_id")


# Sinks


@query
def sink_parquet_roundtrip(spark, sf_dir):
    folder, rows = scratch_path(spark, "sink"), staged(_charges(spark, sf_dir), "charges")
    for _ in range(2):
        rows.write.mode("overwrite").parquet(folder)
    return files.scan_parquet(spark, folder)


@query
def sink_replace_table(spark, sf_dir):
    lake = _lake(spark, "replace")
    for setting in ("inpatient", "outpatient"):
        lake.replace("charges", _charges(spark, sf_dir).filter(F.col("care_setting") == setting))
    return lake.read("charges")


@query
def sink_append_or_create(spark, sf_dir):
    lake = _lake(spark, "append")
    for setting in ("inpatient", "outpatient"):
        lake.append("charges", _charges(spark, sf_dir).filter(F.col("care_setting") == setting))
    return lake.read("charges")


@query
def drop_tables(spark, sf_dir):
    lake = _lake(spark, "drops")
    lake.replace("kept", _charges(spark, sf_dir))
    for table in ("dropped_one", "dropped_two"):
        lake.replace(table, lake.read("kept"))
    lake.drop(["dropped_one", "dropped_two", "never_there"])
    return _with_row_counts(lake, tables.describe_tables(spark, lake.namespace).select("table_name"))


# Flatten and align


@query
def array_first(spark, sf_dir):
    docs = fixtures.documents(spark, sf_dir)
    headed = flatten.document_header(docs, F.lit(None))
    return headed.select("hospital_name", "hospital_address", "hospital_location")


@query
def struct_project(spark, sf_dir):
    docs = fixtures.documents(spark, sf_dir)
    return docs.select("hospital_name", "license_information.license", "license_information.state")


@query
def struct_expand(spark, sf_dir):
    return fixtures.documents(spark, sf_dir).select("license_information.*")


def _payers_of_each_charge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every derived document's payer list, whatever level above it is empty."""
    rows = fixtures.charges(spark, sf_dir, order_columns=True)
    return fixtures.with_payers(rows).select("hospital_name", "payers")


@query
def explode_inner(spark, sf_dir):
    opened = flatten.open_array(_payers_of_each_charge(spark, sf_dir), "payers", "payer", keep_empty=False)
    return opened.select("hospital_name", "payer.payer_name", "payer.plan_name", "payer.billing_class", "payer.methodology")


@query
def explode_outer(spark, sf_dir):
    opened = flatten.open_array(_payers_of_each_charge(spark, sf_dir), "payers", "payer", keep_empty=True)
    return opened.select("hospital_name", "payer.payer_name", "payer.plan_name", "payer.billing_class", "payer.methodology")


@query
def flatten_code_charge(spark, sf_dir):
    headed = flatten.document_header(fixtures.documents(spark, sf_dir), F.lit(None))
    return flatten.code_charge_rows(headed, keep_empty=False).select(
        "hospital_name", "service_description", "code", "modifiers", "code_type", "care_setting",
        "gross_charge", "discounted_cash", "min_charge", "max_charge",
    )


@query
def flatten_type1(spark, sf_dir):
    return flatten.flatten_type1(fixtures.documents(spark, sf_dir))


@query
def flatten_type2(spark, sf_dir):
    return flatten.flatten_type2(fixtures.documents(spark, sf_dir))


@query
def flatten_both(spark, sf_dir):
    return flatten.flatten_documents(fixtures.documents(spark, sf_dir), rebalance=True)


@query
def detect_variant(spark, sf_dir):
    docs = fixtures.documents(spark, sf_dir)
    by_variant = docs.groupBy("hospital_name", flatten.document_variant().alias("variant"))
    return by_variant.agg(F.count(F.lit(1)).alias("documents"))


def _suppliers_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = fixtures.table(spark, sf_dir, "supplier")
    return named.select(F.col("s_name").alias("hospital_name"), F.col("s_suppkey").cast("string").alias("hospital_id"))


@query
def coalesce_fields(spark, sf_dir):
    return flatten.flatten_any_license(fixtures.documents(spark, sf_dir), _suppliers_by_name(spark, sf_dir))


@query
def provider_id_fallback(spark, sf_dir):
    filled = flatten.with_hospital_ids(fixtures.documents(spark, sf_dir), _suppliers_by_name(spark, sf_dir))
    by_id = filled.groupBy("hospital_name", F.col("pId").alias("hospital_id"))
    return by_id.agg(F.count(F.lit(1)).alias("documents"))


@query
def align_csv(spark, sf_dir):
    rows = _charges(spark, sf_dir)
    wide = rows.select(*[
        F.col(name).cast("string").alias(header) for name, header in schemas.CSV_HEADERS.items() if name in rows.columns
    ])
    return flatten.align_csv(wide, truncate_cents=True)


@query
def align_csv_groups(spark, sf_dir):
    """Two numbered codes and two payers in the header; some lines lack one or the other."""
    rows, one = _charges(spark, sf_dir), F.lit(None).cast("string")
    code = F.col("code").cast("int")
    wide = rows.select(
        F.col("hospital_id").alias("provider_id"), F.col("service_description").alias("description"), F.col("care_setting").alias("setting"),
        F.when(code % 7 != 0, F.col("code")).alias("code | 1"), F.col("code_type").alias("code | 1 | type"),
        F.when(code % 3 == 0, F.concat(F.lit("N"), "code")).alias("code | 2"), F.lit("NDC").alias("code | 2 | type"), one.alias("code | 3"),
        F.col("gross_charge").cast("string").alias("standard_charge | gross"),
        F.col("standard_charge_dollar").cast("string").alias("standard_charge | Acme Health | Gold PPO | negotiated_dollar"),
        F.col("methodology").alias("standard_charge | Acme Health | Gold PPO | methodology"),
        F.col("standard_charge_percentage").cast("string").alias("standard_charge | Beta | HMO | negotiated_percentage"),
        F.when(code % 5 == 0, F.lit("see contract")).alias("additional_payer_notes | Beta | HMO"),
    )
    return flatten.align_csv_groups(wide).select(
        "hospital_id", "service_description", "care_setting", "code", "code_type", "gross_charge", "payer_name", "plan_name",
        "methodology", "standard_charge_dollar", "standard_charge_percentage", "additional_payer_notes")


@query
def normalize_name(spark, sf_dir):
    customers = fixtures.table(spark, sf_dir, "customer")
    path = F.concat(F.lit("file:/in/"), "c_mktsegment", F.lit(" Clinic-"), "c_name", F.lit("_TX.json"))
    return customers.select("c_custkey", columns.file_stem(path).alias("source_name"))


@query
def project_keep_list(spark, sf_dir):
    kept, _ = enrich.keep_columns(score.score(_stored_silver(spark, sf_dir)), schemas.SCORED_SILVER)
    return kept


# Filters and cleaning


@query
def drop_critical_nulls(spark, sf_dir):
    return clean.drop_missing(_charges(spark, sf_dir), clean.REQUIRED_STRICT)


@query
def filter_consistency(spark, sf_dir):
    return clean.keep_consistent(_charges(spark, sf_dir))


@query
def unclassified_services(spark, sf_dir):
    return quality.unclassified_services(_silver(spark, sf_dir))


@query
def payer_info_missing(spark, sf_dir):
    return _charges(spark, sf_dir).select(
        "hospital_id", "code", "payer_name", "plan_name", "methodology",
        columns.payer_info_missing().alias("payer_info_missing"),
    )


@query
def dedup_rows(spark, sf_dir):
    rows = _charges(spark, sf_dir)
    return rows.union(rows).dropDuplicates()


@query
def dedup_after_standardize(spark, sf_dir):
    rows = _charges(spark, sf_dir)
    respelled = rows.withColumn("payer_name", F.concat(F.lit(" "), F.lower("payer_name"), F.lit(" ")))
    return clean.clean_strict(rows.union(respelled), dedup_after_standardize=True)


@query
def standardize_text(spark, sf_dir):
    return clean.standardize(_charges(spark, sf_dir)).select("hospital_id", "code", "payer_name", "plan_name")


@query
def parse_date(spark, sf_dir):
    return clean.standardize(_charges(spark, sf_dir)).select("hospital_id", "code", "last_updated_on")


@query
def impute_gross_midpoint(spark, sf_dir):
    filled = clean.impute_gross(_charges(spark, sf_dir))
    return filled.select("hospital_id", "code", "min_charge", "max_charge", "gross_charge")


@query
def impute_standard(spark, sf_dir):
    filled = clean.impute_from_gross(_charges(spark, sf_dir), "standard_charge_dollar")
    return filled.select("hospital_id", "code", "gross_charge", "standard_charge_dollar")


@query
def impute_cash(spark, sf_dir):
    filled = clean.impute_from_gross(_charges(spark, sf_dir), "discounted_cash")
    return filled.select("hospital_id", "code", "gross_charge", "discounted_cash")


@query
def null_profile(spark, sf_dir):
    return clean.null_profile(_charges(spark, sf_dir))


@query
def clean_strict(spark, sf_dir):
    return clean.clean_strict(_charges(spark, sf_dir))


@query
def clean_impute(spark, sf_dir):
    return clean.clean_impute(_charges(spark, sf_dir))


# Scalar enrichment


@query
def stamp_run_ts(spark, sf_dir):
    return enrich.stamp(_charges(spark, sf_dir).select("hospital_id", "code"), "silver_ingestion_ts", _run_ts())


def _classification(column: str, *inputs: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return enrich.classify(_charges(spark, sf_dir), column).select("hospital_id", "code", *inputs, column)

    return run


QUERIES |= {
    "classify_payer": _classification("payer_category", "payer_name", "plan_name"),
    "classify_pricing": _classification("pricing_model", "methodology"),
    "classify_plan": _classification("plan_type", "plan_name"),
    "classify_treatment": _classification("treatment_type", "service_description"),
    "flag_medication": _classification("is_medication", "service_description"),
    "classify_drug_form": _classification("drug_form", "service_description"),
    "classify_imaging": _classification("imaging_type", "service_description"),
    "flag_lab_test": _classification("is_lab_test", "service_description"),
    "flag_brand": _classification("has_brand_indicator", "service_description"),
}


@query
def bucket_charge(spark, sf_dir):
    amount = "standard_charge_dollar"
    return _charges(spark, sf_dir).select(
        "hospital_id", "code", amount, columns.charge_bucket(F.col(amount)).alias("charge_bucket")
    )


@query
def patient_amount(spark, sf_dir):
    return _charges(spark, sf_dir).select(
        "hospital_id", "code", "gross_charge", "standard_charge_dollar",
        columns.patient_amount().alias("estimated_patient_amount"),
    )


@query
def split_address(spark, sf_dir):
    parts = enrich.split_address(_charges(spark, sf_dir))
    return parts.select("hospital_id", "code", "hospital_address", "street", "city", "state", "zip_code")


@query
def enrich_silver(spark, sf_dir):
    return _silver(spark, sf_dir)


# Joins


@query
def anti_new_members(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir, "payer_name", "payer_category")
    known = silver.filter(F.col("payer_category").isin("Commercial", "Other")).select("payer_name").distinct()
    return new_members(silver.select("payer_name").distinct(), known, ["payer_name"], null_safe=False)


@query
def unmatched_plans(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir, *schemas.PLAN_METADATA, "pricing_model")
    known = silver.filter((F.col("pricing_model") == "Case Rate") & (F.col("plan_type") != "Other"))
    return quality.unmatched_plans(quality.plan_metadata(silver), known)


def _payers(silver: DataFrame) -> DataFrame:
    known = silver.sparkSession.createDataFrame([], "payer_id bigint, payer_name string")
    return dimensions.payer_additions(silver, known)


def _plans(silver: DataFrame) -> DataFrame:
    known = silver.sparkSession.createDataFrame([], "plan_id bigint, plan_name string")
    return dimensions.plan_additions(silver, known)


@query
def fact_payer_lookup(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir, "hospital_id", "code", "payer_name", "gross_charge")
    keyed = dimensions.with_payer_key(silver, _payers(silver))
    return keyed.select("hospital_id", "code", "payer_name", "gross_charge", "payer_id")


@query
def fact_plan_lookup(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir, "hospital_id", "code", "plan_name", "gross_charge")
    keyed = dimensions.with_plan_key(silver, _plans(silver))
    return keyed.select("hospital_id", "code", "plan_name", "gross_charge", "plan_id")


@query
def coverage_join(spark, sf_dir):
    covered = score.with_coverage(_stored_silver(spark, sf_dir, *SERVICE_KEY, "gross_charge", "payer_name"))
    return covered.select("hospital_id", "code", "service_description", "gross_charge", "payer_coverage_count")


# Aggregations


@query
def payer_coverage(spark, sf_dir):
    return score.payer_coverage(_silver(spark, sf_dir))


@query
def global_max(spark, sf_dir):
    return _charges(spark, sf_dir).agg(F.max("standard_charge_dollar").alias("highest"))


@query
def count_rows(spark, sf_dir):
    rows = F.count(F.lit(1))
    return _charges(spark, sf_dir).agg(rows.alias("row_count"), (rows > 0).alias("has_rows"))


@query
def distinct_subset(spark, sf_dir):
    return _charges(spark, sf_dir).select("hospital_id", "hospital_name", "license_number", "license_state").distinct()


# Windows and scores


@query
def price_rank(spark, sf_dir):
    ranked = score.with_price_rank(_stored_silver(spark, sf_dir, *SERVICE_KEY, "standard_charge_dollar"))
    return ranked.select(*SERVICE_KEY, "standard_charge_dollar", "price_rank")


@query
def price_rank_with_nulls(spark, sf_dir):
    rows = _charges(spark, sf_dir).select(*SERVICE_KEY, "standard_charge_dollar")
    return score.with_price_rank(staged(rows, "charges"))


@query
def service_max(spark, sf_dir):
    scored = score.score(_stored_silver(spark, sf_dir, *SCORE_INPUT))
    return scored.select("service_description", "max_price_rank", "max_coverage").distinct()


@query
def surrogate_keys(spark, sf_dir):
    names = fixtures.table(spark, sf_dir, "part").select("p_name").distinct()
    return dimensions.number_members(names, "p_name", "name_id", after=1000)


@query
def score_price(spark, sf_dir):
    return score.score(_stored_silver(spark, sf_dir, *SCORE_INPUT)).select(*SERVICE_KEY, "price_rank", "max_price_rank", "score_price")


@query
def score_coverage(spark, sf_dir):
    scored = score.score(_stored_silver(spark, sf_dir, *SCORE_INPUT))
    return scored.select(*SERVICE_KEY, "payer_coverage_count", "max_coverage", "score_coverage")


@query
def score_coverage_global(spark, sf_dir):
    scored = score.score(_stored_silver(spark, sf_dir, *SCORE_INPUT), coverage_scope="global")
    return scored.select(*SERVICE_KEY, "payer_coverage_count", "max_coverage", "score_coverage")


@query
def score_brand(spark, sf_dir):
    return score.score(_stored_silver(spark, sf_dir, *SCORE_INPUT)).select(*SERVICE_KEY, "has_brand_indicator", "score_brand")


@query
def final_score_by_counts(spark, sf_dir):
    """The counts that the final score rests on, next to it."""
    scored = score.score(_stored_silver(spark, sf_dir, *SCORE_INPUT))
    return scored.select(*SERVICE_KEY, "payer_name", "price_rank", "max_price_rank", "final_score")


@query
def final_score(spark, sf_dir):
    return score.score(_stored_silver(spark, sf_dir, *SCORE_INPUT)).select(
        *SERVICE_KEY, "payer_name", "plan_name", "standard_charge_dollar", "price_rank", "payer_coverage_count",
        "score_price", "score_coverage", "score_brand", "final_score",
    )


@query
def best_plan_per_service(spark, sf_dir):
    return score.best_plans(score.score(_stored_silver(spark, sf_dir, *SCORE_INPUT)), k=3)


@query
def coverage_merged(spark, sf_dir):
    """Each delivery is read for its own bitmaps only; the count comes from the stored bitmaps of both."""
    lake, silver = _lake(spark, "coverage"), _stored_silver(spark, sf_dir, *SERVICE_KEY, "payer_name", "care_setting")
    for setting in ("inpatient", "outpatient"):
        delivery = silver.filter(F.col("care_setting") == setting)
        lake.append("dim_payer", dimensions.payer_additions(delivery, lake.read_or_empty("dim_payer", "payer_id bigint, payer_name string")))
        keyed = dimensions.with_payer_key(delivery, lake.read("dim_payer"))
        lake.append("coverage", score.coverage_bitmaps(keyed).withColumn("delivery", F.lit(setting)), ["delivery"])
    return score.merged_coverage(lake.read("coverage"))


# Star schema


def _grown_payers(spark: SparkSession, sf_dir: str, first_category: str) -> DataFrame:
    silver = _stored_silver(spark, sf_dir, "payer_name", "payer_category")
    first = staged(_payers(silver.filter(F.col("payer_category") == first_category)), "payers")
    return dimensions.merged_dimension(first, dimensions.payer_additions(silver, first))


@query
def union_dims(spark, sf_dir):
    return _grown_payers(spark, sf_dir, "Commercial")


@query
def dim_payer(spark, sf_dir):
    return _grown_payers(spark, sf_dir, "Medicare")


@query
def dim_plan(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir, "plan_name", "plan_type")
    first = staged(_plans(silver.filter(F.col("plan_type") == "HMO")), "plans")
    return dimensions.merged_dimension(first, dimensions.plan_additions(silver, first))


def _grown_attributes(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> DataFrame:
    silver = _stored_silver(spark, sf_dir, *dict.fromkeys([*names, "care_setting"]))
    inpatient = silver.filter(F.col("care_setting") == "inpatient")
    first = staged(dimensions.attribute_additions(inpatient, None, names), "members")
    return dimensions.merged_dimension(first, dimensions.attribute_additions(silver, first, names))


@query
def dim_hospital(spark, sf_dir):
    return _grown_attributes(spark, sf_dir, schemas.DIM_HOSPITAL)


def _moving_hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charges whose hospital has moved to another city in every other year."""
    dated = enrich.split_address(clean.standardize(_charges(spark, sf_dir)))
    away = (F.col("hospital_id").cast("int") % 3 == 0) & (F.year("last_updated_on") % 2 == 1)
    return dated.withColumn("city", F.when(away, "Dallas").otherwise(F.col("city")))


@query
def dim_hospital_history(spark, sf_dir):
    stated = history.states(_moving_hospitals(spark, sf_dir), "hospital_id", "last_updated_on", ["hospital_name", "city"])
    return history.validity_intervals(staged(stated, "states"), "hospital_id", "last_updated_on")


@query
def fact_hospital_version(spark, sf_dir):
    """Each charge finds the city its hospital had at the charge's date."""
    charges = _moving_hospitals(spark, sf_dir)
    stated = staged(history.states(charges, "hospital_id", "last_updated_on", ["hospital_name", "city"]), "states")
    versions = history.validity_intervals(stated, "hospital_id", "last_updated_on")
    facts = charges.select("hospital_id", "code", "last_updated_on", "gross_charge")
    return history.as_of(facts, versions, "hospital_id", "last_updated_on").drop("hospital_name")


@query
def dim_procedure(spark, sf_dir):
    return _grown_attributes(spark, sf_dir, schemas.DIM_PROCEDURE)


@query
def dim_payer_wide(spark, sf_dir):
    return dimensions.attribute_additions(_silver(spark, sf_dir), None, schemas.DIM_PAYER_WIDE)


@query
def fact_charges(spark, sf_dir):
    silver = enrich.stamp(_stored_silver(spark, sf_dir), "gold_ingestion_ts", _run_ts())
    return dimensions.fact_charges(silver, _payers(silver), _plans(silver))


@query
def fact_charges_flat(spark, sf_dir):
    silver = enrich.stamp(_silver(spark, sf_dir), "gold_ingestion_ts", _run_ts())
    return silver.select(*schemas.FACT_CHARGES_FLAT)


@query
def plan_metadata(spark, sf_dir):
    return quality.plan_metadata(_silver(spark, sf_dir))


# Jobs


@query
def ingest_bronze(spark, sf_dir):
    lake = _lake(spark, "bronze")
    jobs.ingest(lake, _all_documents(spark, sf_dir), _run_ts(local=False), known_ids=_suppliers_by_name(spark, sf_dir))
    return jobs.bronze_charges(lake).drop("source_id")


@query
def ingest_mixed_folder(spark, sf_dir):
    """Documents and wide CSV in one folder, each taken by the run for its format."""
    lake, folder = _lake(spark, "mixed"), scratch_path(spark, "mixed")
    with released(spark):
        fixtures.write_documents(fixtures.documents(spark, sf_dir), f"{folder}/documents", packed=True)
    fixtures.write_csv(_charges(spark, sf_dir), f"{folder}/wide")
    for file_format in ("json", "csv"):
        jobs.ingest(lake, folder, _run_ts(local=False), file_format=file_format, known_ids=_suppliers_by_name(spark, sf_dir))
    return jobs.bronze_charges(lake).drop("source_id")


@query
def rejected_documents(spark, sf_dir):
    """Documents that have lost their license and items are set aside with what is left of their header."""
    lake, folder = _lake(spark, "rejects"), scratch_path(spark, "broken")
    broken = F.col("hospital_name").endswith("9")
    with released(spark):
        docs = fixtures.documents(spark, sf_dir)
        emptied = docs.withColumns({
            name: F.when(~broken, F.col(name)) for name in ("license_information", "standard_charge_information")})
        fixtures.write_documents(emptied, folder, packed=True)
    jobs.ingest(lake, folder, _run_ts(local=False))
    return jobs.rejected_documents(lake).drop("source_id", "license_number", "license_state")


@query
def unknown_fields(spark, sf_dir):
    """Documents with fields that the schema does not know, at four levels of nesting."""
    lake, folder = _lake(spark, "drift"), scratch_path(spark, "drift")
    note = F.struct(F.lit("n").alias("kind"), F.array(F.lit(1), F.lit(2)).alias("pages"))

    def with_more(one: Column) -> Column:
        charges = F.transform(one["standard_charges"], lambda charge: charge.withField(
            "payers_information", F.transform(charge["payers_information"], lambda payer: payer.withField("in_network", F.lit(True)))))
        marked = F.when(F.get(one["code_information"], F.lit(0))["code"].endswith("7"), F.lit("later"))
        return one.withField("standard_charges", charges).withField("review", marked)

    with released(spark):
        grown = fixtures.documents(spark, sf_dir).withColumns({
            "license_information": F.col("license_information").withField("issued", F.lit("1999")),
            "standard_charge_information": F.transform("standard_charge_information", with_more),
            "policy": F.when(F.col("hospital_name").endswith("3"), note)})
        fixtures.write_documents(grown, folder, packed=True)
    jobs.ingest(lake, folder, _run_ts(local=False))
    jobs.keep_unknown_fields(lake, _run_ts(local=False))
    per_file = jobs.unknown_fields(lake)
    return per_file.groupBy("field", "type").agg(F.sum("occurrences").alias("occurrences"))


@query
def rejected_records(spark, sf_dir):
    """Documents cut off after their name and CSV lines with too few values, next to sound ones."""
    lake, folder, charges = _lake(spark, "records"), scratch_path(spark, "cut"), _charges(spark, sf_dir)
    cut = F.concat(F.lit('{"hospital_name": "'), "hospital_name")
    with released(spark):
        docs = fixtures.documents(spark, sf_dir)
        text = F.when(F.col("hospital_name").endswith("9"), cut).otherwise(F.to_json(F.struct(*[c for c in docs.columns if c != "setting"])))
        fixtures.write_lines(docs.select(text.alias("value")), f"{folder}/documents")
    headers = {name: header for name, header in schemas.CSV_HEADERS.items() if name in charges.columns}
    short = F.concat_ws(",", "code", "care_setting", F.lit("cut"))
    whole = F.to_csv(F.struct(*[F.col(name).cast("string") for name in headers]))
    lines = charges.select(F.when(F.col("code").endswith("7"), short).otherwise(whole).alias("value"))
    fixtures.write_lines(lines, f"{folder}/wide", ",".join(headers.values()))
    jobs.ingest(lake, f"{folder}/documents", _run_ts(local=False), multi_line=False)
    jobs.ingest(lake, f"{folder}/wide", _run_ts(local=False), file_format="csv")
    return jobs.rejected_records(lake).drop("source_id")


@query
def ingest_csv(spark, sf_dir):
    lake, folder = _lake(spark, "csv"), scratch_path(spark, "csv-files")
    fixtures.write_csv(_charges(spark, sf_dir), folder)
    jobs.ingest(lake, folder, _run_ts(local=False), file_format="csv")
    return jobs.bronze_charges(lake).drop("source_id")


@query
def compacted_bronze(spark, sf_dir):
    """Two deliveries, each compacted after it came, the second into partitions of the first."""
    lake = _lake(spark, "compacted")
    for folder, run_ts in zip(_delivered(spark, sf_dir, "inpatient", "outpatient"), (F.lit("2025-03-01 01:00:00").cast("timestamp"), _run_ts(local=False)), strict=True):
        jobs.ingest(lake, folder, run_ts, known_ids=_suppliers_by_name(spark, sf_dir))
        jobs.compact(lake)
    return jobs.bronze_charges(lake).drop("source_id")


@query
def refine_silver(spark, sf_dir):
    lake = _lake(spark, "refine")
    delivered = _delivered(spark, sf_dir, "inpatient", "outpatient")
    jobs.ingest(lake, delivered, _run_ts(local=False), known_ids=_suppliers_by_name(spark, sf_dir))
    jobs.refine(lake, _run_ts(local=False))
    return _without_zone(lake.read("silver_charges").drop("source_id"))


@query
def scored_silver(spark, sf_dir):
    lake = _lake(spark, "scored")
    delivered = _delivered(spark, sf_dir, "inpatient", "outpatient")
    jobs.ingest(lake, delivered, _run_ts(local=False), known_ids=_suppliers_by_name(spark, sf_dir))
    jobs.refine(lake, _run_ts(local=False))
    jobs.score_run(lake, _run_ts(local=False))
    return _without_zone(lake.read("scored_silver").drop("source_id"))


@query
def build_gold(spark, sf_dir):
    """The second run must neither add members nor repeat facts."""
    lake = _lake(spark, "gold")
    silver = _stamped_silver(spark, sf_dir)
    for _ in range(2):
        jobs.build_gold(lake, silver, _run_ts(local=False))
    return _without_zone(lake.read("fact_charges"))


@query
def export_gold_twice(spark, sf_dir):
    """Two deliveries through all jobs, each exported; names are looked up in the exported dimensions."""
    lake, target = _lake(spark, "lake"), _lake(spark, "target")
    runs = ("2025-03-01 12:00:00.5", "2025-03-01 12:00:00.75")
    for folder, run_ts in zip(_delivered(spark, sf_dir, "inpatient", "outpatient"), runs, strict=True):
        jobs.run_all(lake, folder, F.lit(run_ts).cast("timestamp"), target, known_ids=_suppliers_by_name(spark, sf_dir))
    export_gold(lake, target)
    named = target.read("fact_charges").join(target.read("dim_payer"), "payer_id", "left")
    return named.join(target.read("dim_plan"), "plan_id", "left").select(
        "hospital_id", "payer_name", "plan_name", "code", "gross_charge", "standard_charge_dollar", "charge_bucket"
    )


def _stamped_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as it is stored, with the run time of the jobs."""
    return clean.clean_strict(_charges(spark, sf_dir), then=partial(enrich.enrich, run_ts=_run_ts(local=False)))


def _exported_with_names(target: Lakehouse) -> DataFrame:
    named = exported(target, target.spark).join(target.read("dim_payer"), "payer_id", "left")
    return _without_zone(named.select("hospital_id", "payer_name", "code", "gross_charge", "standard_charge_dollar", "gold_ingestion_ts"))


@query
def export_late_run(spark, sf_dir):
    """A run of an earlier date comes after a later one was exported, and the later one is built again with fewer rows."""
    lake, target, silver = _lake(spark, "lake"), _lake(spark, "target"), _stamped_silver(spark, sf_dir)
    early, late = F.lit(EARLIER_TS).cast("timestamp"), _run_ts(local=False)
    inpatient = F.col("care_setting") == "inpatient"
    for rows, run_ts in ((inpatient, late), (~inpatient, early), (inpatient & (F.col("code_type") == "CPT"), late)):
        jobs.build_gold(lake, silver.filter(rows), run_ts)
        export_gold(lake, target)
    return _exported_with_names(target)


class _Interrupted(Lakehouse):
    """A target whose next export ends early: before the mark, or within the facts."""

    fails_at: str | None = None

    def append(self, table, df, partition_by=()):
        if table == self.fails_at:
            if table == FACTS:
                super().append(table, df.filter(F.col("code").endswith("1")), partition_by)
            raise InterruptedError(table)
        super().append(table, df, partition_by)


@query
def export_after_failure(spark, sf_dir):
    """One export fails between facts and mark, one within the facts; what the next ones leave has every fact once."""
    lake, silver = _lake(spark, "lake"), _stamped_silver(spark, sf_dir)
    target = _Interrupted(spark, f"target_{uuid4().hex[:12]}", scratch_path(spark, "target"))
    inpatient = F.col("care_setting") == "inpatient"
    runs = ((inpatient, F.lit(EARLIER_TS).cast("timestamp"), LEDGER), (~inpatient, _run_ts(local=False), FACTS))
    for rows, run_ts, fails_at in runs:
        jobs.build_gold(lake, silver.filter(rows), run_ts)
        target.fails_at = fails_at
        try:
            export_gold(lake, target)
        except InterruptedError:
            target.fails_at = None
    export_gold(lake, target)
    return _exported_with_names(target)


@query
def stream_pickup(spark, sf_dir):
    """The second start finds nothing new."""
    lake, folder = _lake(spark, "stream"), _all_documents(spark, sf_dir)
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for _ in range(2):
        start_pickup(lake, folder, checkpoint, known_ids=_suppliers_by_name(spark, sf_dir)).awaitTermination()
    return jobs.bronze_charges(lake).drop("source_id")


@query
def stream_then_refine(spark, sf_dir):
    """Streamed files are recorded, so the next job finds them."""
    lake, checkpoint = _lake(spark, "streamed"), scratch_path(spark, "stream-checkpoint")
    for folder in _delivered(spark, sf_dir, "inpatient", "outpatient"):
        start_pickup(lake, folder, f"{checkpoint}/{folder[-8:]}", _run_ts(local=False), known_ids=_suppliers_by_name(spark, sf_dir)).awaitTermination()
    jobs.refine(lake, _run_ts(local=False))
    return _without_zone(lake.read("silver_charges").drop("source_id"))


@query
def stream_redelivered(spark, sf_dir):
    """The second delivery holds the first one's files once more under other names; they are not taken again."""
    lake, folder, checkpoint = _lake(spark, "again"), scratch_path(spark, "again"), scratch_path(spark, "stream-checkpoint")
    docs = fixtures.documents(spark, sf_dir)
    inpatient = F.col("setting") == "inpatient"
    for delivery in ([("first", inpatient)], [("copies", inpatient), ("second", ~inpatient)]):
        for name, rows in delivery:
            fixtures.write_documents(docs.filter(rows), f"{folder}/{name}", packed=True)
        start_pickup(lake, folder, checkpoint, known_ids=_suppliers_by_name(spark, sf_dir), on_duplicate="reject").awaitTermination()
    return jobs.bronze_charges(lake).drop("source_id")
