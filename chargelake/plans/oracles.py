"""The queries' expected results as SQL over the same tables."""

from __future__ import annotations

from chargelake.fixtures import CHARGES_SQL, TABLES

RUN_TS = "2025-03-01 12:00:00.123456"
TS = f"TIMESTAMP '{RUN_TS}'"
EARLIER_TS = "2025-02-01 06:30:00"

_CHARGES = CHARGES_SQL.format(**{name: name for name in TABLES})

_ADDRESS = """trim(string_split(hospital_address, ',')[1]) AS street,
  trim(string_split(hospital_address, ',')[2]) AS city,
  regexp_extract(trim(string_split(hospital_address, ',')[3]), '([A-Z]{2})', 1) AS state,
  regexp_extract(trim(string_split(hospital_address, ',')[3]), '(\\d{5})', 1) AS zip_code"""

# The patterns and labels that the rules must have, stated here once more and on their own.
_PAYER_CATEGORY = """CASE
  WHEN regexp_matches(payer_name, '(?i)aetna|cigna|humana|anthem|imagine health|blue cross') THEN 'Commercial'
  WHEN regexp_matches(payer_name, '(?i)medicare|provider partners|devoted') THEN 'Medicare'
  WHEN regexp_matches(payer_name, '(?i)medicaid|community first|molina') THEN 'Medicaid'
  WHEN regexp_matches(plan_name, '(?i)HIX|exchange|blue advantage') THEN 'Exchange' ELSE 'Other' END AS payer_category"""
_PRICING = """CASE WHEN regexp_matches(methodology, '(?i)case rate') THEN 'Case Rate'
  WHEN regexp_matches(methodology, '(?i)fee schedule') THEN 'Fee Schedule'
  WHEN regexp_matches(methodology, '(?i)percent|percentage') THEN 'Percentage-Based' ELSE 'Other' END AS pricing_model"""
_PLAN = """CASE WHEN regexp_matches(plan_name, '(?i)hmo') THEN 'HMO' WHEN regexp_matches(plan_name, '(?i)ppo') THEN 'PPO'
  WHEN regexp_matches(plan_name, '(?i)hix|exchange') THEN 'Exchange'
  WHEN regexp_matches(plan_name, '(?i)medicare|medicaid') THEN 'Government' ELSE 'Other' END AS plan_type"""
_BUCKET = """CASE WHEN standard_charge_dollar < 100 THEN 'Low' WHEN standard_charge_dollar BETWEEN 100 AND 1000 THEN 'Medium'
  WHEN standard_charge_dollar > 1000 THEN 'High' ELSE 'Unknown' END AS charge_bucket"""
_AMOUNT = "gross_charge - standard_charge_dollar AS estimated_patient_amount"
_MISSING = "(payer_name IS NULL OR plan_name IS NULL OR methodology IS NULL) AS payer_info_missing"


def _service(pattern: str) -> str:
    return f"regexp_matches(lower(service_description), '{pattern}')"


def _flag(pattern: str, name: str) -> str:
    return f"coalesce({_service(pattern)}, false) AS {name}"


_TREATMENT = f"""CASE WHEN {_service("mri|ct|x-ray|ultrasound|imaging")} THEN 'Imaging'
  WHEN {_service("injection|inj|tablet|tb|cp|oral|syrup|mg|solution|suspension")} THEN 'Medication'
  WHEN {_service("biopsy|surgery|resection|repair|ablation|implant|arthroplasty|graft")} THEN 'Procedure'
  WHEN {_service("panel|ab/|antibody|lab|urine|test|analysis|level|quant")} THEN 'Lab Test'
  WHEN {_service("device|supply|graft|stent|pump|dressing")} THEN 'Supply/Device' ELSE 'Other' END AS treatment_type"""
_MEDICATION = _flag("mg|tb|cp|solution|suspension|syrup|inhalation|injection", "is_medication")
_DRUG_FORM = f"""CASE WHEN {_service("tb|tablet|cp")} THEN 'Tablet' WHEN {_service("inj|injection|ij")} THEN 'Injection'
  WHEN {_service("sol|solution")} THEN 'Solution' WHEN {_service("cream|ointment")} THEN 'Topical'
  WHEN {_service("inhalation|ih|is")} THEN 'Inhaler' ELSE 'Other' END AS drug_form"""
_IMAGING = f"""CASE WHEN {_service("mri")} THEN 'MRI' WHEN {_service("ct")} THEN 'CT Scan' WHEN {_service("x-ray")} THEN 'X-Ray'
  WHEN {_service("ultrasound")} THEN 'Ultrasound' END AS imaging_type"""
_LAB = _flag("panel|antibody|test|level|urine|blood|cbc|cmp|lipid", "is_lab_test")
_BRAND = _flag("stryker|depuy|bard|zimmer|philips|medtronic|covidien|smith", "has_brand_indicator")

_STANDARD = """SELECT * REPLACE (upper(trim(payer_name)) AS payer_name, upper(trim(plan_name)) AS plan_name,
  try_cast(last_updated_on AS DATE) AS last_updated_on) FROM """
_STRICT_FILTER = """hospital_id IS NOT NULL AND hospital_name IS NOT NULL AND service_description IS NOT NULL
  AND gross_charge IS NOT NULL AND standard_charge_dollar IS NOT NULL
  AND gross_charge > 0 AND min_charge <= max_charge AND gross_charge >= standard_charge_dollar"""


def _silver_columns(ts: str = TS) -> str:
    return ", ".join([
        "*", f"{ts} AS silver_ingestion_ts", _PAYER_CATEGORY, _PRICING, _PLAN, _BUCKET, _AMOUNT, _MISSING, _TREATMENT,
        _MEDICATION, _DRUG_FORM, _IMAGING, _LAB, _BRAND, _ADDRESS,
    ])


# Named parts; a query lists what it needs and each may use those before it.
PARTS = {
    "charges": f"SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM ({_CHARGES})",
    "strict": f"{_STANDARD} (SELECT DISTINCT * FROM charges WHERE {_STRICT_FILTER})",
    "silver": f"SELECT {_silver_columns()} FROM strict",
    "moving": f"""SELECT * REPLACE (CASE WHEN CAST(hospital_id AS INT) % 3 = 0 AND year(last_updated_on) % 2 = 1 THEN 'Dallas' ELSE city END AS city)
        FROM (SELECT *, {_ADDRESS} FROM ({_STANDARD} charges))""",
    "ranked": """SELECT *, CAST(rank() OVER (PARTITION BY service_description
        ORDER BY standard_charge_dollar NULLS FIRST) AS BIGINT) AS price_rank FROM silver""",
    "coverage": """SELECT service_description, count(DISTINCT payer_name) AS payer_coverage_count
        FROM silver GROUP BY service_description""",
    "covered": "SELECT ranked.*, payer_coverage_count FROM ranked LEFT JOIN coverage USING (service_description)",
    "maxima": """SELECT *, max(price_rank) OVER (PARTITION BY service_description) AS max_price_rank,
        max(payer_coverage_count) OVER (PARTITION BY service_description) AS max_coverage FROM covered""",
    "parts": """SELECT *, CAST(max_price_rank - price_rank AS DOUBLE) / max_price_rank AS score_price,
        CAST(payer_coverage_count AS DOUBLE) / nullif(max_coverage, 0) AS score_coverage,
        CAST(has_brand_indicator AS DOUBLE) AS score_brand FROM maxima""",
    "scored": """SELECT *, score_price * CAST(0.5 AS DOUBLE) + score_coverage * CAST(0.3 AS DOUBLE)
        + score_brand * CAST(0.2 AS DOUBLE) AS final_score FROM parts""",
    "dim_payer": """SELECT row_number() OVER (ORDER BY payer_name NULLS FIRST) AS payer_id, payer_name
        FROM (SELECT DISTINCT payer_name FROM silver)""",
    "dim_plan": """SELECT row_number() OVER (ORDER BY plan_name) AS plan_id, plan_name
        FROM (SELECT DISTINCT plan_name FROM silver WHERE plan_name IS NOT NULL)""",
}
_NEEDS = {
    "strict": ["charges"], "moving": ["charges"], "silver": ["strict"], "ranked": ["silver"], "coverage": ["silver"],
    "covered": ["ranked", "coverage"], "maxima": ["covered"], "parts": ["maxima"], "scored": ["parts"],
    "dim_payer": ["silver"], "dim_plan": ["silver"],
}


def using(*parts: str, then: str, extra: dict[str, str] | None = None) -> str:
    """A query over the named parts, with those they build on put first."""
    ordered: list[str] = []

    def need(part: str) -> None:
        for earlier in _NEEDS.get(part, []):
            need(earlier)
        if part not in ordered:
            ordered.append(part)

    for part in parts:
        need(part)
    named = {part: PARTS[part] for part in ordered} | (extra or {})
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in named.items()) + "\n" + then


# Hospital documents as lists. A kept empty level becomes one NULL element.
_NESTED = {
    "nested": f"""SELECT *, CAST(hospital_id AS INT) % 10 AS kind,
        CASE WHEN CAST(hospital_id AS INT) % 10 % 3 <> 0 OR CAST(hospital_id AS INT) % 10 = 3 THEN hospital_id END AS own_id,
        CASE WHEN CAST(hospital_id AS INT) % 10 <> 2 THEN hospital_name || ' campus' END AS hospital_location,
        CASE WHEN l_orderkey % 11 = 0 THEN [] ELSE [1] END AS items,
        CASE WHEN CAST(code AS INT) % 13 = 0 THEN [] WHEN CAST(code AS INT) % 3 = 0 THEN [1, 2] ELSE [1] END AS codes,
        CASE WHEN l_linenumber = 7 THEN [] WHEN l_linenumber = 2 THEN [1, 2] ELSE [1] END AS amounts,
        CASE WHEN payer_name IS NULL THEN [] WHEN l_linenumber = 4 THEN [1, 2] ELSE [1] END AS payers
        FROM ({_CHARGES})""",
}


def _opened(outer: bool) -> dict[str, str]:
    """The levels opened one after another, empty ones dropped or kept."""

    def level(values: str, above: str | None) -> str:
        if not outer:
            return f"unnest({values})"
        reachable = f"{above} IS NULL OR len({values}) = 0" if above else f"len({values}) = 0"
        return f"unnest(CASE WHEN {reachable} THEN [NULL] ELSE {values} END)"

    tag = "2" if outer else "1"
    return {
        f"item{tag}": f"SELECT *, {level('items', None)} AS item FROM nested",
        f"coded{tag}": f"SELECT *, {level('codes', 'item')} AS code_no FROM item{tag}",
        f"priced{tag}": f"SELECT *, {level('amounts', 'item')} AS amount_no FROM coded{tag}",
        f"paid{tag}": f"SELECT *, {level('payers', 'amount_no')} AS payer_no FROM priced{tag}",
    }


_HEAD = "hospital_name, hospital_address, hospital_location, last_updated_on"
_ITEM = "CASE WHEN item IS NOT NULL THEN service_description END AS service_description"
_DRUG = "CASE WHEN item IS NOT NULL THEN 'ML' END AS drug_type, CASE WHEN item IS NOT NULL THEN modifiers END AS drug_unit"
_CODE = """CASE code_no WHEN 1 THEN code WHEN 2 THEN 'N' || code END AS code, CASE code_no WHEN 1 THEN modifiers END AS modifiers,
  CASE code_no WHEN 1 THEN code_type WHEN 2 THEN 'NDC' END AS code_type"""
_CHARGE = """CASE amount_no WHEN 1 THEN care_setting WHEN 2 THEN 'both' END AS care_setting,
  gross_charge * amount_no AS gross_charge,
  CASE WHEN amount_no IS NOT NULL THEN discounted_cash END AS discounted_cash,
  CASE WHEN amount_no IS NOT NULL THEN min_charge END AS min_charge,
  CASE WHEN amount_no IS NOT NULL THEN max_charge END AS max_charge"""
_PAYER_NAMES = """CASE payer_no WHEN 1 THEN payer_name WHEN 2 THEN 'Uninsured' END AS payer_name,
  CASE payer_no WHEN 1 THEN plan_name END AS plan_name,
  CASE WHEN payer_no IS NOT NULL THEN 'facility' END AS billing_class,
  CASE payer_no WHEN 1 THEN methodology WHEN 2 THEN 'Case Rate' END AS methodology"""
_DOLLAR = """CASE WHEN payer_no = 1 AND l_linenumber <> 5 THEN standard_charge_dollar WHEN payer_no = 2 THEN discounted_cash END
  AS standard_charge_dollar"""
_ANY_DOLLAR = "CASE payer_no WHEN 1 THEN standard_charge_dollar WHEN 2 THEN discounted_cash END AS standard_charge_dollar"
_PERCENT = "CASE payer_no WHEN 1 THEN standard_charge_percentage END AS standard_charge_percentage"
_NOTES = "CASE WHEN payer_no = 1 AND l_linenumber = 6 THEN 'see contract' END AS additional_payer_notes"
_ALGORITHM = "CASE WHEN payer_no = 1 AND l_linenumber = 3 THEN 'fee x 2' END AS standard_charge_algorithm"
_PIDX = "CASE payer_no WHEN 1 THEN concat('P', l_linenumber) WHEN 2 THEN 'P0' END AS payer_id"
_LICENSE_1 = "CASE WHEN kind < 5 THEN license_number END AS license_number, license_state"
_LICENSE_2 = "CASE WHEN kind >= 5 AND kind < 9 THEN license_number END AS license_number, license_state"


def _flat_columns(variant: int, superset: bool, ids: str = "own_id", dollar: str = _DOLLAR) -> str:
    no_drug = ["NULL AS drug_type", "NULL AS drug_unit"] if superset else []
    license_number = "license_number, license_state" if superset else _LICENSE_1 if variant == 1 else _LICENSE_2
    columns = [f"{ids} AS hospital_id", _HEAD, license_number, _ITEM]
    columns += [_DRUG] if variant == 2 else no_drug
    columns += [_CODE, _CHARGE, _PAYER_NAMES, dollar, _PERCENT, _NOTES]
    if variant == 1:
        columns += [_ALGORITHM] + (["NULL AS payer_id"] if superset else [])
    else:
        columns += (["NULL AS standard_charge_algorithm"] if superset else []) + [_PIDX]
    return ", ".join(columns)


def _with(named: dict[str, str], then: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in named.items()) + "\n" + then


def nested(then: str) -> str:
    return _with(_NESTED | _opened(False) | _opened(True), then)


def _bronze(where: str = "true", ids: str = "own_id", dollar: str = _DOLLAR) -> str:
    """Both variants as bronze rows, of the documents that meet a condition."""
    return f"""SELECT {_flat_columns(1, True, ids, dollar)} FROM (SELECT * FROM paid1 WHERE (kind < 5 OR kind = 9) AND {where})
        UNION ALL SELECT {_flat_columns(2, True, ids, dollar)} FROM (SELECT * FROM paid2 WHERE kind >= 5 AND kind < 9 AND {where})"""


def _ingested(where: str = "true") -> str:
    """The same as the jobs store it: with all hospital ids and estimated amounts."""
    return _bronze(where, "CAST(hospital_id AS VARCHAR)", _ANY_DOLLAR)


def refined_parts(prefix: str = "", source: str = "bronze") -> dict[str, str]:
    """Bronze rows cleaned and enriched, as the jobs do."""
    return {
        f"{prefix}clean": f"{_STANDARD} (SELECT DISTINCT * FROM {source} WHERE {_STRICT_FILTER})",
        f"{prefix}silver": f"SELECT {_silver_columns()} FROM {prefix}clean",
    }


_KEY = "hospital_id, code, payer_name, plan_name, methodology"
_FACT = """hospital_id, payer_id, plan_id, code, gross_charge, discounted_cash, min_charge, max_charge,
  estimated_patient_amount, standard_charge_dollar, standard_charge_percentage, charge_bucket, payer_info_missing,
  silver_ingestion_ts, gold_ingestion_ts"""
_PROCEDURE = """code, modifiers, code_type, care_setting, treatment_type, is_medication, drug_form, imaging_type,
  is_lab_test, has_brand_indicator"""
_HOSPITAL = "hospital_id, hospital_name, city, state, license_number, license_state"
_SERVICE_KEY = "hospital_id, code, service_description"
_FACT_FROM_SILVER = f"""SELECT {_FACT} FROM (SELECT *, {TS} AS gold_ingestion_ts FROM silver) s
  LEFT JOIN dim_payer p ON s.payer_name IS NOT DISTINCT FROM p.payer_name LEFT JOIN dim_plan pl ON s.plan_name = pl.plan_name"""

_PROFILED = (
    "hospital_id", "hospital_name", "hospital_address", "last_updated_on", "license_number", "license_state",
    "service_description", "code", "modifiers", "code_type", "care_setting", "payer_name", "plan_name", "methodology",
    "billing_class", "gross_charge", "discounted_cash", "min_charge", "max_charge", "standard_charge_dollar",
    "standard_charge_percentage",
)
_STAMPED_LINES = """SELECT l_orderkey, l_partkey, l_shipdate + to_microseconds(CAST(l_quantity AS BIGINT)) AS gold_ingestion_ts,
  l_shipdate FROM lineitem"""
_BATCH_1, _BATCH_2 = "care_setting = 'inpatient'", "care_setting = 'outpatient'"


def _charges(then: str) -> str:
    return using("charges", then=then)


def _silver(then: str) -> str:
    return using("silver", then=then)


def _scored(columns: str) -> str:
    return using("scored", then=f"SELECT {columns} FROM scored")


def _refined(then: str, *parts: str) -> str:
    """Two deliveries of documents, each refined by itself."""
    named = _NESTED | _opened(False) | _opened(True) | {
        "bronze_in": _ingested(_BATCH_1), "bronze_out": _ingested(_BATCH_2),
        **refined_parts("in_", "bronze_in"), **refined_parts("out_", "bronze_out"),
        "silver": "SELECT * FROM in_silver UNION ALL SELECT * FROM out_silver",
        **{part: PARTS[part] for part in parts},
    }
    return _with(named, then)


def _classified(column: str, inputs: str) -> str:
    return _charges(f"SELECT hospital_id, code, {inputs}, {column} FROM charges")


def _two_step_keys(name: str, key: str, first: str, keep_null: bool) -> str:
    """Keys of the members of a first batch, then of those that only the whole table has."""
    known = "true" if keep_null else f"{name} IS NOT NULL"
    return using("silver", then=f"""SELECT * FROM seen UNION ALL SELECT {key}, {name} FROM (
        SELECT (SELECT max({key}) FROM seen) + row_number() OVER (ORDER BY {name} NULLS FIRST) AS {key}, {name}
        FROM (SELECT DISTINCT {name} FROM silver WHERE {known}
              AND NOT EXISTS (SELECT 1 FROM seen WHERE seen.{name} IS NOT DISTINCT FROM silver.{name})))""",
        extra={"seen": f"""SELECT row_number() OVER (ORDER BY {name} NULLS FIRST) AS {key}, {name}
            FROM (SELECT DISTINCT {name} FROM silver WHERE {first} AND {known})"""})


_EXPORTED = "hospital_id, payer_name, code, gross_charge, standard_charge_dollar"
_CSV_ROWS = _charges("""SELECT * REPLACE (CAST(hospital_id AS VARCHAR) AS hospital_id), NULL AS hospital_location,
    NULL AS drug_type, NULL AS drug_unit, NULL AS additional_payer_notes, NULL AS standard_charge_algorithm,
    NULL AS payer_id FROM charges""")

_SCORED_COLUMNS = """hospital_id, hospital_name, city, state, last_updated_on, license_number,
        license_state, code, modifiers, code_type, care_setting, gross_charge, discounted_cash, min_charge, max_charge,
        payer_name, plan_name, billing_class, methodology, standard_charge_dollar, standard_charge_percentage,
        silver_ingestion_ts, payer_category, pricing_model, plan_type, charge_bucket, payer_info_missing, treatment_type,
        is_medication, drug_form, imaging_type, is_lab_test, has_brand_indicator, max_price_rank, max_coverage,
        score_price, score_coverage, score_brand, final_score"""

ORACLES: dict[str, str] = {
    # sources
    "scan_json_nested": _with(_NESTED | _opened(False) | _opened(True), _bronze()),
    "scan_json_split": _with(_NESTED | _opened(False) | _opened(True), _bronze()),
    "scan_csv": _CSV_ROWS,
    "scan_parquet": _charges("SELECT * FROM charges"),
    "scan_table": _charges("SELECT * FROM charges"),
    "incremental_scan": f"""WITH stamped AS ({_STAMPED_LINES}) SELECT l_orderkey, l_partkey, gold_ingestion_ts FROM stamped
        WHERE gold_ingestion_ts > (SELECT max(gold_ingestion_ts) FROM stamped WHERE l_shipdate < TIMESTAMP '1998-01-01')""",
    "catalog_listing": _silver("""SELECT 'charges' AS table_name, 21 AS columns, count(*) AS row_count FROM charges
        UNION ALL SELECT 'dim_plan', 1, count(DISTINCT plan_name) FROM silver
        UNION ALL SELECT 'silver', 38, count(*) FROM silver"""),
    "adhoc_code_lookup": _charges("""SELECT plan_name, code, gross_charge, discounted_cash, standard_charge_percentage
        FROM charges WHERE code = '17' ORDER BY plan_name NULLS FIRST, code, gross_charge NULLS FIRST,
        discounted_cash NULLS FIRST, standard_charge_percentage NULLS FIRST LIMIT 10"""),
    "code_lookup_skipping": _charges("""SELECT plan_name, code, gross_charge, discounted_cash, standard_charge_percentage
        FROM charges WHERE code = '17' ORDER BY plan_name NULLS FIRST, code, gross_charge NULLS FIRST,
        discounted_cash NULLS FIRST, standard_charge_percentage NULLS FIRST LIMIT 10"""),
    "distinct_services": _charges("SELECT DISTINCT service_description FROM charges ORDER BY 1 LIMIT 100"),
    "ingest_new_only": _with(_NESTED | _opened(False) | _opened(True), _ingested(_BATCH_2)),
    # sinks
    "sink_parquet_roundtrip": _charges("SELECT * FROM charges"),
    "sink_replace_table": _charges("SELECT * FROM charges WHERE care_setting = 'outpatient'"),
    "sink_append_or_create": _charges("SELECT * FROM charges"),
    "drop_tables": _charges("SELECT 'kept' AS table_name, count(*) AS row_count FROM charges"),
    "watermark_advance": f"""WITH stamped AS ({_STAMPED_LINES})
        SELECT 'lines' AS table_name, max(gold_ingestion_ts) AS high_ts FROM stamped WHERE l_shipdate < TIMESTAMP '1998-01-01'
        UNION ALL SELECT 'lines', max(gold_ingestion_ts) FROM stamped""",
    # flatten and align
    "array_first": f"SELECT hospital_name, hospital_address, CASE WHEN s % 10 <> 2 THEN hospital_name || ' campus' END "
        f"AS hospital_location FROM (SELECT *, CAST(hospital_id AS INT) AS s FROM ({_CHARGES}))",
    "struct_project": f"SELECT hospital_name, CASE WHEN s % 10 < 5 THEN license_number END AS license, license_state AS state "
        f"FROM (SELECT *, CAST(hospital_id AS INT) AS s FROM ({_CHARGES}))",
    "struct_expand": f"""SELECT CASE WHEN kind < 5 THEN license_number END AS license,
        CASE WHEN kind >= 5 AND kind < 9 THEN license_number END AS license_number,
        CASE WHEN kind = 9 THEN license_number END AS hospital_license_number, license_state AS state
        FROM (SELECT *, CAST(hospital_id AS INT) % 10 AS kind FROM ({_CHARGES}))""",
    "explode_inner": nested(f"SELECT hospital_name, {_PAYER_NAMES} FROM (SELECT *, unnest(payers) AS payer_no FROM nested)"),
    "explode_outer": nested(f"""SELECT hospital_name, {_PAYER_NAMES} FROM (
        SELECT *, unnest(CASE WHEN len(payers) = 0 THEN [NULL] ELSE payers END) AS payer_no FROM nested)"""),
    "flatten_code_charge": nested(f"SELECT hospital_name, service_description, {_CODE}, {_CHARGE} FROM priced1"),
    "flatten_type1": nested(f"SELECT {_flat_columns(1, False)} FROM paid1"),
    "flatten_type2": nested(f"SELECT {_flat_columns(2, False)} FROM paid2"),
    "flatten_both": _with(_NESTED | _opened(False) | _opened(True), _bronze()),
    "detect_variant": nested("""SELECT hospital_name, CASE WHEN kind < 5 THEN 1 WHEN kind < 9 THEN 2 ELSE 1 END AS variant,
        count(*) AS documents FROM nested GROUP BY ALL"""),
    "coalesce_fields": nested(f"""SELECT CAST(hospital_id AS VARCHAR) AS hospital_id, {_HEAD}, license_number, license_state,
        {_ITEM}, {_CODE}, {_CHARGE}, {_PAYER_NAMES}, {_ANY_DOLLAR}, {_PERCENT}, {_NOTES}, {_ALGORITHM} FROM paid1"""),
    "provider_id_fallback": nested("SELECT hospital_name, hospital_id, count(*) AS documents FROM nested GROUP BY ALL"),
    "align_csv": _charges("""SELECT * REPLACE (trunc(min_charge) AS min_charge, trunc(max_charge) AS max_charge,
        trunc(standard_charge_dollar) AS standard_charge_dollar, trunc(standard_charge_percentage) AS standard_charge_percentage),
        NULL AS hospital_location, NULL AS drug_type, NULL AS drug_unit, NULL AS additional_payer_notes,
        NULL AS standard_charge_algorithm, NULL AS payer_id FROM charges"""),
    "align_csv_groups": _charges("""SELECT CAST(hospital_id AS VARCHAR) AS hospital_id, service_description, care_setting,
        CASE n WHEN 1 THEN code WHEN 2 THEN 'N' || code END AS code, CASE n WHEN 1 THEN code_type WHEN 2 THEN 'NDC' END AS code_type,
        gross_charge, CASE p WHEN 1 THEN 'Acme Health' WHEN 2 THEN 'Beta' END AS payer_name,
        CASE p WHEN 1 THEN 'Gold PPO' WHEN 2 THEN 'HMO' END AS plan_name, CASE p WHEN 1 THEN methodology END AS methodology,
        CASE p WHEN 1 THEN standard_charge_dollar END AS standard_charge_dollar,
        CASE p WHEN 2 THEN standard_charge_percentage END AS standard_charge_percentage,
        CASE WHEN p = 2 AND CAST(code_as_read AS INT) % 5 = 0 THEN 'see contract' END AS additional_payer_notes
        FROM (SELECT *, code AS code_as_read,
          unnest(CASE WHEN x % 7 = 0 AND x % 3 <> 0 THEN [NULL] WHEN x % 7 = 0 THEN [2] WHEN x % 3 = 0 THEN [1, 2] ELSE [1] END) AS n,
          CASE WHEN a AND b THEN [1, 2] WHEN a THEN [1] WHEN b THEN [2] ELSE [NULL] END AS ps
          FROM (SELECT *, CAST(code AS INT) AS x, standard_charge_dollar IS NOT NULL OR methodology IS NOT NULL AS a,
            standard_charge_percentage IS NOT NULL OR CAST(code AS INT) % 5 = 0 AS b FROM charges)), unnest(ps) AS u(p)"""),
    "normalize_name": """SELECT c_custkey, replace(replace(lower(concat(c_mktsegment, ' Clinic-', c_name, '_TX')), ' ', '_'), '-', '_')
        AS source_name FROM customer""",
    "project_keep_list": using("scored", then=f"SELECT {_SCORED_COLUMNS} FROM scored"),
    # filters and cleaning
    "drop_critical_nulls": _charges("""SELECT * FROM charges WHERE hospital_id IS NOT NULL AND hospital_name IS NOT NULL
        AND service_description IS NOT NULL AND gross_charge IS NOT NULL AND standard_charge_dollar IS NOT NULL"""),
    "filter_consistency": _charges("""SELECT * FROM charges WHERE gross_charge > 0 AND min_charge <= max_charge
        AND gross_charge >= standard_charge_dollar"""),
    "unclassified_services": _silver("""SELECT service_description, count(*) AS charge_rows FROM silver
        WHERE treatment_type = 'Other' GROUP BY 1"""),
    "payer_info_missing": _classified(_MISSING, "payer_name, plan_name, methodology"),
    "dedup_rows": _charges("SELECT DISTINCT * FROM (SELECT * FROM charges UNION ALL SELECT * FROM charges)"),
    "dedup_after_standardize": _charges(f"""SELECT DISTINCT * FROM ({_STANDARD} (SELECT * FROM charges WHERE {_STRICT_FILTER}
        UNION ALL SELECT * REPLACE (' ' || lower(payer_name) || ' ' AS payer_name) FROM charges WHERE {_STRICT_FILTER}))"""),
    "standardize_text": _charges("""SELECT hospital_id, code, upper(trim(payer_name)) AS payer_name,
        upper(trim(plan_name)) AS plan_name FROM charges"""),
    "parse_date": _charges("SELECT hospital_id, code, try_cast(last_updated_on AS DATE) AS last_updated_on FROM charges"),
    "impute_gross_midpoint": _charges("""SELECT hospital_id, code, min_charge, max_charge,
        coalesce(gross_charge, (min_charge + max_charge) / 2) AS gross_charge FROM charges"""),
    "impute_standard": _charges("""SELECT hospital_id, code, gross_charge,
        coalesce(standard_charge_dollar, gross_charge) AS standard_charge_dollar FROM charges"""),
    "impute_cash": _charges("""SELECT hospital_id, code, gross_charge,
        coalesce(discounted_cash, gross_charge) AS discounted_cash FROM charges"""),
    "null_profile": _charges(" UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) - count({name}) AS missing_count FROM charges" for name in _PROFILED)),
    "clean_strict": using("strict", then="SELECT * FROM strict"),
    "clean_impute": using("charges", then=f"""{_STANDARD} (SELECT DISTINCT * FROM (
        SELECT * REPLACE (coalesce(standard_charge_dollar, gross_charge) AS standard_charge_dollar,
          coalesce(discounted_cash, gross_charge) AS discounted_cash)
        FROM (SELECT * REPLACE (coalesce(gross_charge, (min_charge + max_charge) / 2) AS gross_charge) FROM charges
              WHERE min_charge IS NOT NULL AND max_charge IS NOT NULL))
        WHERE hospital_id IS NOT NULL AND hospital_name IS NOT NULL AND service_description IS NOT NULL
          AND gross_charge IS NOT NULL)"""),
    # scalar enrichment
    "stamp_run_ts": _charges(f"SELECT hospital_id, code, {TS} AS silver_ingestion_ts FROM charges"),
    "classify_payer": _classified(_PAYER_CATEGORY, "payer_name, plan_name"),
    "classify_pricing": _classified(_PRICING, "methodology"),
    "classify_plan": _classified(_PLAN, "plan_name"),
    "bucket_charge": _classified(_BUCKET, "standard_charge_dollar"),
    "patient_amount": _classified(_AMOUNT, "gross_charge, standard_charge_dollar"),
    "classify_treatment": _classified(_TREATMENT, "service_description"),
    "flag_medication": _classified(_MEDICATION, "service_description"),
    "classify_drug_form": _classified(_DRUG_FORM, "service_description"),
    "classify_imaging": _classified(_IMAGING, "service_description"),
    "flag_lab_test": _classified(_LAB, "service_description"),
    "flag_brand": _classified(_BRAND, "service_description"),
    "split_address": _charges(f"SELECT hospital_id, code, hospital_address, {_ADDRESS} FROM charges"),
    "enrich_silver": _silver("SELECT * FROM silver"),
    # joins
    "anti_new_members": _silver("""SELECT DISTINCT payer_name FROM silver WHERE NOT EXISTS (
        SELECT 1 FROM silver k WHERE k.payer_category IN ('Commercial', 'Other') AND k.payer_name = silver.payer_name)"""),
    "unmatched_plans": _silver("""SELECT DISTINCT payer_name, plan_name, payer_category, plan_type FROM silver m
        WHERE NOT EXISTS (SELECT 1 FROM silver k WHERE k.pricing_model = 'Case Rate' AND k.plan_type <> 'Other'
          AND k.payer_name = m.payer_name AND k.plan_name = m.plan_name)"""),
    "fact_payer_lookup": using("dim_payer", then="""SELECT hospital_id, code, s.payer_name, gross_charge, payer_id FROM silver s
        LEFT JOIN dim_payer p ON s.payer_name IS NOT DISTINCT FROM p.payer_name"""),
    "fact_plan_lookup": using("dim_plan", then="""SELECT hospital_id, code, s.plan_name, gross_charge, plan_id FROM silver s
        LEFT JOIN dim_plan p ON s.plan_name = p.plan_name"""),
    "coverage_join": using("silver", "coverage", then="""SELECT hospital_id, code, service_description, gross_charge,
        payer_coverage_count FROM silver LEFT JOIN coverage USING (service_description)"""),
    # aggregations
    "payer_coverage": using("coverage", then="SELECT * FROM coverage"),
    "global_max": _charges("SELECT max(standard_charge_dollar) AS highest FROM charges"),
    "count_rows": _charges("SELECT count(*) AS row_count, count(*) > 0 AS has_rows FROM charges"),
    "distinct_subset": _charges("SELECT DISTINCT hospital_id, hospital_name, license_number, license_state FROM charges"),
    # windows and scores
    "price_rank": using("ranked", then=f"SELECT {_SERVICE_KEY}, standard_charge_dollar, price_rank FROM ranked"),
    "price_rank_with_nulls": _charges(f"""SELECT {_SERVICE_KEY}, standard_charge_dollar, CAST(rank() OVER (
        PARTITION BY service_description ORDER BY standard_charge_dollar NULLS FIRST) AS BIGINT) AS price_rank FROM charges"""),
    "service_max": using("maxima", then="""SELECT DISTINCT service_description, max_price_rank, max_coverage FROM maxima"""),
    "surrogate_keys": """SELECT row_number() OVER (ORDER BY p_name) + 1000 AS name_id, p_name
        FROM (SELECT DISTINCT p_name FROM part)""",
    "score_price": _scored(f"{_SERVICE_KEY}, price_rank, max_price_rank, score_price"),
    "score_coverage": _scored(f"{_SERVICE_KEY}, payer_coverage_count, max_coverage, score_coverage"),
    "score_coverage_global": using("parts", then=f"""SELECT {_SERVICE_KEY}, payer_coverage_count,
        max(payer_coverage_count) OVER () AS max_coverage,
        CAST(payer_coverage_count AS DOUBLE) / max(payer_coverage_count) OVER () AS score_coverage FROM parts"""),
    "score_brand": _scored(f"{_SERVICE_KEY}, has_brand_indicator, score_brand"),
    "final_score_by_counts": _scored(f"{_SERVICE_KEY}, payer_name, price_rank, max_price_rank, final_score"),
    "final_score": _scored("""hospital_id, code, service_description, payer_name, plan_name, standard_charge_dollar,
        price_rank, payer_coverage_count, score_price, score_coverage, score_brand, final_score"""),
    "best_plan_per_service": using("scored", then="""SELECT service_description, CAST(place AS INTEGER) AS place, payer_name, plan_name, hospital_id,
        standard_charge_dollar, final_score FROM (SELECT *, row_number() OVER (PARTITION BY service_description
            ORDER BY final_score DESC, standard_charge_dollar, payer_name NULLS FIRST, plan_name NULLS FIRST, hospital_id) AS place
        FROM (SELECT *, row_number() OVER (PARTITION BY service_description, payer_name, plan_name
            ORDER BY final_score DESC, standard_charge_dollar, hospital_id) AS own FROM scored WHERE final_score IS NOT NULL) WHERE own = 1)
        WHERE place <= 3"""),
    "coverage_merged": using("coverage", then="SELECT * FROM coverage"),
    # star schema
    "union_dims": _two_step_keys("payer_name", "payer_id", "payer_category = 'Commercial'", True),
    "dim_hospital": _silver(f"SELECT DISTINCT {_HOSPITAL} FROM silver"),
    "dim_hospital_history": using("moving", then="""SELECT hospital_id, hospital_name, city, last_updated_on AS valid_from,
        lead(last_updated_on) OVER (PARTITION BY hospital_id ORDER BY last_updated_on) AS valid_to FROM (
            SELECT *, lag(city) OVER w AS before, row_number() OVER w AS nth FROM (
                SELECT DISTINCT hospital_id, hospital_name, city, last_updated_on FROM moving WHERE last_updated_on IS NOT NULL)
            WINDOW w AS (PARTITION BY hospital_id ORDER BY last_updated_on))
        WHERE nth = 1 OR city IS DISTINCT FROM before"""),
    "fact_hospital_version": using("moving", then="""SELECT hospital_id, code, last_updated_on, gross_charge,
        CASE WHEN last_updated_on IS NOT NULL THEN city END AS city FROM moving"""),
    "dim_payer": _two_step_keys("payer_name", "payer_id", "payer_category = 'Medicare'", True),
    "dim_plan": _two_step_keys("plan_name", "plan_id", "plan_type = 'HMO'", False),
    "dim_procedure": _silver(f"SELECT DISTINCT {_PROCEDURE} FROM silver"),
    "fact_charges": using("dim_payer", "dim_plan", then=_FACT_FROM_SILVER),
    "dim_payer_wide": _silver("""SELECT DISTINCT payer_name, plan_name, billing_class, methodology, payer_category,
        pricing_model, plan_type FROM silver"""),
    "fact_charges_flat": _silver(f"""SELECT hospital_id, payer_name, code, gross_charge, discounted_cash, min_charge, max_charge,
        standard_charge_dollar, standard_charge_percentage, charge_bucket, payer_info_missing, silver_ingestion_ts,
        {TS} AS gold_ingestion_ts FROM silver"""),
    "plan_metadata": _silver("SELECT DISTINCT payer_name, plan_name, payer_category, plan_type FROM silver"),
    # jobs
    "ingest_bronze": _with(_NESTED | _opened(False) | _opened(True), _ingested()),
    "ingest_mixed_folder": _with(
        _NESTED | _opened(False) | _opened(True) | {"wide": _CSV_ROWS}, f"{_ingested()} UNION ALL BY NAME SELECT * FROM wide"),
    "rejected_documents": _with(_NESTED, """SELECT own_id AS hospital_id, hospital_name, hospital_address, hospital_location,
        last_updated_on FROM nested WHERE ends_with(hospital_name, '9')"""),
    "scored_silver": _refined(f"SELECT {_SCORED_COLUMNS} FROM scored", "ranked", "coverage", "covered", "maxima", "parts", "scored"),
    "stream_then_refine": _refined("SELECT * FROM silver"),
    "ingest_csv": _CSV_ROWS,
    "compacted_bronze": _with(_NESTED | _opened(False) | _opened(True), _ingested()),
    "unknown_fields": nested("""SELECT 'license_information.issued' AS field, 'STRING' AS type, count(*) AS occurrences FROM nested
        UNION ALL SELECT 'policy', 'OBJECT<kind: STRING, pages: ARRAY<BIGINT>>', count(*) FROM nested WHERE ends_with(hospital_name, '3')
        UNION ALL SELECT 'standard_charge_information[].review', 'STRING', count(*) FROM nested
            WHERE len(items) > 0 AND len(codes) > 0 AND ends_with(code, '7')
        UNION ALL SELECT 'standard_charge_information[].standard_charges[].payers_information[].in_network', 'BOOLEAN',
            CAST(sum(len(amounts) * len(payers)) AS BIGINT) FROM nested WHERE len(items) > 0"""),
    "rejected_records": _with(_NESTED, """SELECT 'document does not parse' AS reason, '{"hospital_name": "' || hospital_name AS corrupt_record
        FROM nested WHERE ends_with(hospital_name, '9')
        UNION ALL SELECT 'line does not fit the header', code || ',' || care_setting || ',cut' FROM nested WHERE ends_with(code, '7')"""),
    "refine_silver": _refined("SELECT * FROM silver"),
    "build_gold": using("dim_payer", "dim_plan", then=_FACT_FROM_SILVER),
    "export_gold_twice": _refined("""SELECT hospital_id, payer_name, plan_name, code, gross_charge, standard_charge_dollar,
        charge_bucket FROM silver"""),
    "export_late_run": _silver(f"""SELECT {_EXPORTED}, CASE WHEN care_setting = 'inpatient' THEN {TS}
        ELSE TIMESTAMP '{EARLIER_TS}' END AS gold_ingestion_ts FROM silver WHERE care_setting <> 'inpatient' OR code_type = 'CPT'"""),
    "export_after_failure": _silver(f"""SELECT {_EXPORTED}, CASE WHEN care_setting = 'inpatient' THEN TIMESTAMP '{EARLIER_TS}'
        ELSE {TS} END AS gold_ingestion_ts FROM silver"""),
    "stream_redelivered": _with(_NESTED | _opened(False) | _opened(True), _ingested()),
    "stream_pickup": _with(_NESTED | _opened(False) | _opened(True), _ingested()),
}
