"""Clean rows to silver: categories, flags, buckets and address parts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from chargelake.functions import columns, rules


def stamp(df: DataFrame, name: str, run_ts: datetime | Column | None = None) -> DataFrame:
    """Add the run's timestamp; a given one makes the run repeatable."""
    if run_ts is None:
        run_ts = F.current_timestamp()
    return df.withColumn(name, run_ts if isinstance(run_ts, Column) else F.lit(run_ts))


def classified(lowered: dict[str, Column], whole_words: bool = False) -> dict[str, Column]:
    """Category and flag columns from lower-cased text columns."""
    service = lowered["service_description"]
    return {
        "payer_category": rules.label_by(rules.PAYER_CATEGORY, "Other", lowered, whole_words),
        "pricing_model": rules.label_by(rules.PRICING_MODEL, "Other", lowered, whole_words),
        "plan_type": rules.label_by(rules.PLAN_TYPE, "Other", lowered, whole_words),
        "treatment_type": rules.label_by(rules.TREATMENT_TYPE, "Other", lowered, whole_words),
        "is_medication": rules.flag(service, rules.MEDICATION_TERMS, whole_words),
        "drug_form": rules.label_by(rules.DRUG_FORM, "Other", lowered, whole_words),
        "imaging_type": rules.label_by(rules.IMAGING_TYPE, None, lowered, whole_words),
        "is_lab_test": rules.flag(service, rules.LAB_TEST_TERMS, whole_words),
        "has_brand_indicator": rules.flag(service, rules.BRAND_TERMS, whole_words),
    }


def classify(df: DataFrame, *names: str, whole_words: bool = False) -> DataFrame:
    """Add only the named categories or flags."""
    wanted = classified(rules.lower_texts(), whole_words)
    return df.withColumns({name: wanted[name] for name in names})


def split_address(df: DataFrame, from_end: bool = False) -> DataFrame:
    parts = F.split("hospital_address", ",")
    return df.withColumns(columns.address_columns(parts, from_end))


def enrich(
    df: DataFrame,
    run_ts: datetime | Column | None = None,
    whole_words: bool = False,
    address_from_end: bool = False,
) -> DataFrame:
    """All silver columns, narrow and in one pass; texts are lower-cased and split once per row."""
    prepared = df.select(
        "*",
        *[column.alias(f"_low_{name}") for name, column in rules.lower_texts().items()],
        F.split("hospital_address", ",").alias("_address"),
    )
    added = {
        **classified(rules.lower_texts("_low_"), whole_words),
        "charge_bucket": columns.charge_bucket(F.col("standard_charge_dollar")),
        "estimated_patient_amount": columns.patient_amount(),
        "payer_info_missing": columns.payer_info_missing(),
        **columns.address_columns(F.col("_address"), address_from_end),
    }
    silver = prepared.select(*df.columns, *[column.alias(name) for name, column in added.items()])
    return stamp(silver, "silver_ingestion_ts", run_ts)


def keep_columns(df: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The kept columns in the given order, and the names of those left out."""
    return df.select(*keep), [name for name in df.columns if name not in set(keep)]
