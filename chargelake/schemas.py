"""Declared shapes of everything the library reads or writes.

Nothing is inferred: a missing field reads as NULL, so types never differ between hospitals and no
extra pass over the input is needed to find them.
"""

PAYER = (
    "struct<payer_name:string, plan_name:string, billing_class:string, methodology:string,"
    " standard_charge_dollar:double, estimated_amount:double, standard_charge_percentage:double,"
    " additional_payer_notes:string, standard_charge_algorithm:string, pIdx:string>"
)
CHARGE = (
    "struct<setting:string, gross_charge:double, discounted_cash:double, minimum:double, maximum:double,"
    f" payers_information:array<{PAYER}>>"
)
CODE = "struct<code:string, modifiers:string, type:string>"
ITEM = (
    "struct<description:string, drug_information:struct<type:string, unit:string>,"
    f" code_information:array<{CODE}>, standard_charges:array<{CHARGE}>>"
)
LICENSE = "struct<license:string, license_number:string, hospital_license_number:string, state:string>"

# One row per hospital document; holds the fields of both variants.
DOCUMENT = (
    "pId string, provider_id string, hospital_name string, hospital_address array<string>,"
    " hospital_location array<string>, last_updated_on string,"
    f" license_information {LICENSE}, standard_charge_information array<{ITEM}>"
)

# Fixed values from here on: column names and headers of the published tables and files, in their published order.

# Bronze: one row per item, code, charge and payer. Columns a source lacks stay NULL.
BRONZE = {
    "hospital_id": "string",
    "hospital_name": "string",
    "hospital_address": "string",
    "hospital_location": "string",
    "last_updated_on": "string",
    "license_number": "string",
    "license_state": "string",
    "service_description": "string",
    "drug_type": "string",
    "drug_unit": "string",
    "code": "string",
    "modifiers": "string",
    "code_type": "string",
    "care_setting": "string",
    "gross_charge": "double",
    "discounted_cash": "double",
    "min_charge": "double",
    "max_charge": "double",
    "payer_name": "string",
    "plan_name": "string",
    "billing_class": "string",
    "methodology": "string",
    "standard_charge_dollar": "double",
    "standard_charge_percentage": "double",
    "additional_payer_notes": "string",
    "standard_charge_algorithm": "string",
    "payer_id": "string",
}

# Only the second document variant has these, only the first has the algorithm.
VARIANT_2_ONLY = ("drug_type", "drug_unit", "payer_id")
VARIANT_1_ONLY = ("standard_charge_algorithm",)

# Wide CSV header name for each bronze column; a column without a header is NULL.
CSV_HEADERS = {
    "hospital_id": "provider_id",
    "hospital_name": "hospital_name",
    "hospital_address": "hospital_address",
    "last_updated_on": "last_updated_on",
    "license_number": "license_number",
    "license_state": "license_state",
    "service_description": "description",
    "code": "code | 1",
    "modifiers": "modifiers",
    "code_type": "code | 1 | type",
    "care_setting": "setting",
    "gross_charge": "standard_charge | gross",
    "discounted_cash": "standard_charge | discounted_cash",
    "min_charge": "standard_charge | min",
    "max_charge": "standard_charge | max",
    "payer_name": "payer_name",
    "plan_name": "plan_name",
    "billing_class": "billing_class",
    "methodology": "standard_charge | methodology",
    "standard_charge_dollar": "standard_charge | negotiated_dollar",
    "standard_charge_percentage": "standard_charge | negotiated_percentage",
    "additional_payer_notes": "additional_generic_notes",
    "standard_charge_algorithm": "standard_charge | negotiated_algorithm",
}

# What a payer's own columns in a wide header hold, by the header's kind.
CSV_PAYER_PARTS = {
    "negotiated_dollar": "standard_charge_dollar",
    "negotiated_percentage": "standard_charge_percentage",
    "negotiated_algorithm": "standard_charge_algorithm",
    "methodology": "methodology",
    "estimated_amount": "estimated_amount",
    "additional_payer_notes": "additional_payer_notes",
}

DIM_HOSPITAL = ("hospital_id", "hospital_name", "city", "state", "license_number", "license_state")
DIM_PROCEDURE = (
    "code", "modifiers", "code_type", "care_setting", "treatment_type",
    "is_medication", "drug_form", "imaging_type", "is_lab_test", "has_brand_indicator",
)
DIM_PAYER_WIDE = (
    "payer_name", "plan_name", "billing_class", "methodology",
    "payer_category", "pricing_model", "plan_type",
)
PLAN_METADATA = ("payer_name", "plan_name", "payer_category", "plan_type")
FACT_MEASURES = (
    "code", "gross_charge", "discounted_cash", "min_charge", "max_charge",
    "estimated_patient_amount", "standard_charge_dollar", "standard_charge_percentage",
    "charge_bucket", "payer_info_missing", "silver_ingestion_ts", "gold_ingestion_ts",
)
FACT_CHARGES = ("hospital_id", "payer_id", "plan_id", *FACT_MEASURES)
FACT_CHARGES_FLAT = (
    "hospital_id", "payer_name", "code", "gross_charge", "discounted_cash", "min_charge",
    "max_charge", "standard_charge_dollar", "standard_charge_percentage", "charge_bucket",
    "payer_info_missing", "silver_ingestion_ts", "gold_ingestion_ts",
)
# Columns a scored silver table keeps.
SCORED_SILVER = (
    "hospital_id", "hospital_name", "city", "state", "last_updated_on", "license_number",
    "license_state", "code", "modifiers", "code_type", "care_setting", "gross_charge",
    "discounted_cash", "min_charge", "max_charge", "payer_name", "plan_name", "billing_class",
    "methodology", "standard_charge_dollar", "standard_charge_percentage", "silver_ingestion_ts",
    "payer_category", "pricing_model", "plan_type", "charge_bucket", "payer_info_missing",
    "treatment_type", "is_medication", "drug_form", "imaging_type", "is_lab_test",
    "has_brand_indicator", "max_price_rank", "max_coverage", "score_price", "score_coverage",
    "score_brand", "final_score",
)
