"""Flattening, cleaning, enrichment and model rules on small hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from chargelake import schemas
from chargelake.functions import rules
from chargelake.operators import clean, dimensions, enrich, flatten, quality, score
from chargelake.sources import files

TYPE_1 = {
    "pId": "1", "hospital_name": "A", "hospital_address": ["1 St, X, TX 78205"],
    "license_information": {"license": "L1", "state": "TX"},
    "standard_charge_information": [{
        "description": "d",
        "code_information": [{"code": "c1", "type": "CPT"}, {"code": "c2", "type": "HCPCS"}],
        "standard_charges": [
            {"setting": "inpatient", "gross_charge": 10, "minimum": 1, "maximum": 9, "payers_information": [
                {"payer_name": "P", "plan_name": "HMO", "methodology": "case rate", "standard_charge_dollar": 5},
                {"payer_name": "Q", "plan_name": "PPO", "methodology": "fee schedule", "standard_charge_dollar": 6.5},
            ]},
            {"setting": "outpatient", "gross_charge": 11.5, "minimum": 2, "maximum": 8},
        ],
    }],
}
TYPE_2 = {
    "pId": "2", "hospital_name": "B", "hospital_address": ["2 St, Y, TX 78206"],
    "license_information": {"license_number": "L2", "state": "TX"},
    "standard_charge_information": [{
        "description": "e", "drug_information": {"type": "ML", "unit": "1"},
        "code_information": [{"code": "c3", "type": "NDC"}],
        "standard_charges": [{"setting": "inpatient", "gross_charge": 20, "minimum": 1, "maximum": 9}],
    }],
}
UNKNOWN = {"pId": "3", "hospital_name": "C", "license_information": {"state": "TX"}}


@pytest.fixture
def docs(spark, tmp_path):
    def read(*contents):
        for place, content in enumerate(contents):
            (tmp_path / f"{place}.json").write_text(json.dumps(content, indent=1))
        return files.scan_documents(spark, str(tmp_path))

    return read


def test_type_1_drops_the_charge_without_payers(docs):
    rows = flatten.flatten_type1(docs(TYPE_1)).collect()
    assert sorted((r.code, r.payer_name, r.standard_charge_dollar) for r in rows) == [
        ("c1", "P", 5.0), ("c1", "Q", 6.5), ("c2", "P", 5.0), ("c2", "Q", 6.5)]
    assert len(rows[0]) == 24


def test_type_2_keeps_empty_levels(docs):
    rows = flatten.flatten_type2(docs(TYPE_2)).collect()
    assert [(r.code, r.payer_name, r.drug_type, r.gross_charge) for r in rows] == [("c3", None, "ML", 20.0)]
    assert len(rows[0]) == 26
    assert flatten.flatten_type2(docs(TYPE_1)).count() == 6


def test_both_variants_and_an_unknown_one_in_one_scan(docs):
    found = docs([TYPE_1, TYPE_2], UNKNOWN)
    rows = flatten.flatten_documents(found)
    assert rows.columns == list(schemas.BRONZE)
    assert sorted((r.hospital_id, r.license_number) for r in rows.collect()) == [("1", "L1")] * 4 + [("2", "L2")]
    kept = flatten.flatten_documents(found, keep_unknown=True)
    assert kept.count() == 6
    assert [r.hospital_name for r in kept.filter("document_variant IS NULL").collect()] == ["C"]


def test_other_licenses_drop_no_document(docs):
    third = TYPE_1 | {"license_information": {"hospital_license_number": "L3"}}
    none = TYPE_1 | {"hospital_name": "N", "license_information": {"license": None}}
    rows = flatten.flatten_documents(docs([third, none])).collect()
    assert sum(r.license_number == "L3" for r in rows) == 4
    assert sum(r.hospital_name == "N" for r in rows) == 6  # levels that are empty stay


def test_estimates_and_ids_by_name(docs, spark):
    text = json.dumps(TYPE_1 | {"pId": None}).replace("standard_charge_dollar", "estimated_amount")
    named = spark.createDataFrame([("A", "77")], "hospital_name string, hospital_id string")
    rows = flatten.flatten_documents(docs(json.loads(text)), known_ids=named, estimates=True).collect()
    assert {(r.hospital_id, r.standard_charge_dollar) for r in rows} == {("77", 5.0), ("77", 6.5)}


def test_array_decides_and_not_its_elements(spark):
    df = spark.createDataFrame([(1, [None, "x"]), (2, []), (3, None)], "id int, list array<string>")
    inner, outer = flatten.open_array(df, "list", "e", False), flatten.open_array(df, "list", "e", True)
    by_row = flatten.open_array(df, "list", "e", F.col("id") == 3)
    assert sorted(inner.collect(), key=str) == sorted([(1, None), (1, "x")], key=str)
    assert outer.count() == 4
    assert sorted(r.id for r in by_row.collect()) == [1, 1, 3]


def test_payer_struct_can_be_kept(docs):
    assert "payer" in flatten.flatten_type1(docs(TYPE_1), keep_payer_struct=True).columns


def test_ids_from_literal_mapping(spark):
    df = spark.createDataFrame(
        [("7", None, "A"), (None, "8", "A"), (None, None, "Kindred Hospital Ontario"), (None, None, "A")],
        "pId string, provider_id string, hospital_name string")
    assert [r.pId for r in flatten.with_hospital_ids(df).collect()] == ["7", "8", "106361274", None]
    many = {str(n): "x" for n in range(2000)} | {"A": "9"}
    assert sorted(str(r.pId) for r in flatten.with_hospital_ids(df, many).collect()) == ["7", "8", "9", "None"]


def test_csv_by_header_with_absent_columns_and_bad_numbers(spark, tmp_path):
    header = "description,provider_id,standard_charge | min,standard_charge | max,code | 1 | type\n"
    (tmp_path / "a.csv").write_text(header + 'Knee,9,12.7,n/a,CPT\n')
    aligned = flatten.align_csv(files.scan_csv(spark, str(tmp_path)))
    row = aligned.first()
    assert (row.hospital_id, row.service_description, row.min_charge, row.max_charge) == ("9", "Knee", 12.7, None)
    assert row.payer_name is None and aligned.columns == list(schemas.BRONZE)
    assert flatten.align_csv(files.scan_csv(spark, str(tmp_path)), truncate_cents=True).first().min_charge == 12.0


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("description,provider_id\nKnee,9\n" * 1)
    (tmp_path / "b.csv").write_text("provider_id,description\n9,Knee\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_csv(spark, str(tmp_path)).collect()


BASE = {
    "hospital_id": "1", "hospital_name": "A", "service_description": "x", "gross_charge": 10.0, "discounted_cash": None,
    "standard_charge_dollar": 5.0, "min_charge": 1.0, "max_charge": 9.0, "payer_name": "p", "plan_name": "q",
    "last_updated_on": "2025-01-31",
}
CHARGE_SCHEMA = ", ".join(f"{n} {'double' if isinstance(v, float) or v is None else 'string'}" for n, v in BASE.items())


def charge_rows(spark, *changes):
    return spark.createDataFrame([tuple((BASE | change).values()) for change in changes], CHARGE_SCHEMA)


def test_strict_cleaning(spark):
    df = charge_rows(
        spark, {}, {}, {"payer_name": " P "}, {"gross_charge": None}, {"gross_charge": float("nan")}, {"min_charge": None},
        {"min_charge": 10.0}, {"standard_charge_dollar": 11.0}, {"gross_charge": 0.0, "standard_charge_dollar": 0.0},
        {"last_updated_on": "01/31/2025", "plan_name": None},
    )
    kept = clean.clean_strict(df).collect()
    assert len(kept) == 3
    assert {r.payer_name for r in kept} == {"P"}
    assert sorted(str(r.last_updated_on) for r in kept) == ["2025-01-31", "2025-01-31", "None"]
    assert clean.clean_strict(df, dedup_after_standardize=True).count() == 2


def test_imputing_cleaning(spark):
    df = charge_rows(
        spark, {"gross_charge": None, "standard_charge_dollar": None}, {"max_charge": None},
        {"gross_charge": 0.0, "discounted_cash": 3.0}, {"hospital_id": None})
    got = sorted((r.gross_charge, r.standard_charge_dollar, r.discounted_cash) for r in clean.clean_impute(df).collect())
    assert got == [(0.0, 5.0, 3.0), (5.0, 5.0, 5.0)]


def test_null_profile_counts_nan_and_mixed_types(spark):
    df = spark.createDataFrame(
        [(float("nan"), None, [1], "2024-01-01"), (None, "x", None, None), (1.0, "y", [2], None)],
        "a double, b string, c array<int>, d string").withColumn("d", F.to_date("d"))
    assert [tuple(r) for r in clean.null_profile(df).collect()] == [("a", 2), ("d", 2), ("b", 1), ("c", 1)]


@pytest.mark.parametrize("text, expected", [
    ("MRI BRAIN", ("Imaging", "MRI", False)), ("Injection 5", ("Imaging", "CT Scan", True)),
    ("tablet", ("Medication", None, False)), ("stent graft", ("Procedure", None, False)),
    ("room", ("Other", None, False)), (None, ("Other", None, False)),
])
def test_treatment_rules(spark, text, expected):
    df = spark.createDataFrame([(text, None, None, None)],
                               "service_description string, payer_name string, plan_name string, methodology string")
    row = enrich.classify(df, "treatment_type", "imaging_type", "is_medication").first()
    assert (row.treatment_type, row.imaging_type, row.is_medication) == expected


def test_whole_words_keep_injection_out_of_imaging(spark):
    df = spark.createDataFrame([("Injection 5", "Aetnaville", "x-hmo", None)],
                               "service_description string, payer_name string, plan_name string, methodology string")
    row = enrich.classify(df, "treatment_type", "payer_category", "plan_type", whole_words=True).first()
    assert tuple(row)[-3:] == ("Medication", "Other", "HMO")


def test_shorter_terms_stand_for_longer_ones(spark):
    text = F.lit("hypodermic inj")
    assert spark.range(1).select(rules.contains_any(text, ("injection", "inj"))).first()[0] is True


@pytest.mark.parametrize("amount, bucket", [
    (99.99, "Low"), (100.0, "Medium"), (1000.0, "Medium"), (1000.01, "High"), (float("nan"), "High"), (None, "Unknown")])
def test_charge_bucket(spark, amount, bucket):
    from chargelake.functions.columns import charge_bucket
    assert spark.range(1).select(charge_bucket(F.lit(amount).cast("double"))).first()[0] == bucket


def test_address_from_start_and_end(spark):
    df = spark.createDataFrame([("5 Pine Blvd, Suite 2, Houston, TX 77001",), ("9 Elm Rd, Austin",), (None,)],
                               "hospital_address string")
    start = [tuple(r)[1:] for r in enrich.split_address(df).collect()]
    assert start == [("5 Pine Blvd", "Suite 2", "", ""), ("9 Elm Rd", "Austin", None, None), (None,) * 4]
    end = enrich.split_address(df, from_end=True).first()
    assert tuple(end)[1:] == ("5 Pine Blvd, Suite 2", "Houston", "TX", "77001")


def test_approximate_coverage_is_near(spark):
    df = spark.range(4000).select(F.lit("s").alias("service_description"), (F.col("id") % 500).cast("string").alias("payer_name"))
    near = score.payer_coverage(df, rsd=0.02).first().payer_coverage_count
    assert abs(near - 500) < 50 and score.payer_coverage(df).first().payer_coverage_count == 500


def test_keep_columns_reports_the_rest(spark):
    kept, left_out = enrich.keep_columns(spark.range(1).select("id", F.lit(1).alias("a"), F.lit(2).alias("b")), ["b"])
    assert kept.columns == ["b"] and left_out == ["id", "a"]


def test_null_payer_is_one_member_and_null_plan_none(spark):
    silver = spark.createDataFrame([("B", None), (None, "Y"), ("A", "X"), (None, None)], "payer_name string, plan_name string")
    no_payers = spark.createDataFrame([], "payer_id bigint, payer_name string")
    payers = dimensions.payer_additions(silver, no_payers)
    assert sorted(payers.collect()) == [(1, None), (2, "A"), (3, "B")]
    assert dimensions.payer_additions(silver, payers).count() == 0
    no_plans = spark.createDataFrame([], "plan_id bigint, plan_name string")
    assert sorted(dimensions.plan_additions(silver, no_plans).collect()) == [(1, "X"), (2, "Y")]


def test_repeated_key_is_reported(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    quality.require_unique(df.distinct(), ["k"], "fine")
    with pytest.raises(ValueError, match="not unique"):
        quality.require_unique(df, ["k"], "bad")
