"""The star schema: members to add to each dimension, and facts that carry their keys.

Every function returns only what is new, so a table grows by appends and a repeated run adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from chargelake import schemas
from chargelake.operators.lookup import lookup_join, new_members
from chargelake.operators.ordering import running_total


def number_members(members: DataFrame, name: str, key: str, after: int = 0) -> DataFrame:
    """Consecutive keys in name order, the first being ``after`` + 1. Names must be distinct."""
    counted = members.select(name, F.lit(1).cast("bigint").alias("_one"))
    numbered = running_total(counted, by=[], order=[name], value="_one", name="_place")
    return numbered.select((F.col("_place") + after).alias(key), name)


def highest_key(existing: DataFrame, key: str) -> int:
    return existing.agg(F.max(key)).first()[0] or 0


def _keyed_additions(silver: DataFrame, existing: DataFrame, name: str, key: str, keep_null: bool) -> DataFrame:
    members = silver.select(name).distinct()
    if not keep_null:
        members = members.filter(F.col(name).isNotNull())
    fresh = new_members(members, existing, [name])
    return number_members(fresh, name, key, highest_key(existing, key))


def payer_additions(silver: DataFrame, existing: DataFrame) -> DataFrame:
    """New payers; charges without a payer share one member whose name is NULL."""
    return _keyed_additions(silver, existing, "payer_name", "payer_id", keep_null=True)


def plan_additions(silver: DataFrame, existing: DataFrame) -> DataFrame:
    return _keyed_additions(silver, existing, "plan_name", "plan_id", keep_null=False)


def attribute_additions(silver: DataFrame, existing: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """New distinct combinations of the columns, for dimensions without a surrogate key."""
    members = silver.select(*columns).distinct()
    return members if existing is None else new_members(members, existing, columns)


def merged_dimension(existing: DataFrame, additions: DataFrame) -> DataFrame:
    return existing.unionByName(additions, allowMissingColumns=True)


def with_payer_key(silver: DataFrame, dim_payer: DataFrame) -> DataFrame:
    return lookup_join(silver.drop("payer_id"), dim_payer, ["payer_name"], null_safe=True)


def with_plan_key(silver: DataFrame, dim_plan: DataFrame) -> DataFrame:
    return lookup_join(silver.drop("plan_id"), dim_plan, ["plan_name"])


def fact_charges(silver: DataFrame, dim_payer: DataFrame, dim_plan: DataFrame) -> DataFrame:
    """One fact per silver row, with its payer and plan keys."""
    keyed = with_plan_key(with_payer_key(silver, dim_payer), dim_plan)
    return keyed.select(*schemas.FACT_CHARGES)
