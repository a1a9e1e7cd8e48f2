"""Checks on rule coverage, plan metadata and dimension keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from chargelake import schemas
from chargelake.operators.lookup import new_members


def unclassified_services(silver: DataFrame) -> DataFrame:
    """Descriptions that no treatment rule covers, with how many charges each has."""
    other = silver.filter(F.col("treatment_type") == "Other")
    return other.groupBy("service_description").agg(F.count(F.lit(1)).alias("charge_rows"))


def plan_metadata(silver: DataFrame) -> DataFrame:
    return silver.select(*schemas.PLAN_METADATA).distinct()


def unmatched_plans(metadata: DataFrame, known: DataFrame) -> DataFrame:
    """Payer and plan pairs with no equal pair among the known; a NULL never equals."""
    pair = ["payer_name", "plan_name"]
    return new_members(metadata, known.select(*pair).distinct(), pair, null_safe=False)


def require_unique(df: DataFrame, key: Sequence[str], label: str) -> None:
    """Raise when two rows share a key: a join on it would multiply facts."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    example = repeated.first()
    if example is not None:
        raise ValueError(f"{label}: key {example.asDict()} is not unique")
