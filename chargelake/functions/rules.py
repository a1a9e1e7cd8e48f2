"""Keyword rules of the silver layer, and the columns built from them.

A rule holds when its text contains one of its terms, upper or lower case alike; of several rules the
first that holds gives the label. Terms are searched one by one in the bytes of the text, which a regular
expression would decode anew for each rule. A hundred searches make a long generated method, so sessions should
set ``spark.sql.codegen.hugeMethodLimit`` as ``session.RECOMMENDED`` does. Whole words take an expression.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, functions as F


class Rule(NamedTuple):
    label: str
    column: str
    terms: tuple[str, ...]


# Labels, columns and terms must stay as they are, in this order, for results to be right.
PAYER_CATEGORY = (
    Rule("Commercial", "payer_name", ("aetna", "cigna", "humana", "anthem", "imagine health", "blue cross")),
    Rule("Medicare", "payer_name", ("medicare", "provider partners", "devoted")),
    Rule("Medicaid", "payer_name", ("medicaid", "community first", "molina")),
    Rule("Exchange", "plan_name", ("hix", "exchange", "blue advantage")),
)
PRICING_MODEL = (
    Rule("Case Rate", "methodology", ("case rate",)),
    Rule("Fee Schedule", "methodology", ("fee schedule",)),
    Rule("Percentage-Based", "methodology", ("percent", "percentage")),
)
PLAN_TYPE = (
    Rule("HMO", "plan_name", ("hmo",)),
    Rule("PPO", "plan_name", ("ppo",)),
    Rule("Exchange", "plan_name", ("hix", "exchange")),
    Rule("Government", "plan_name", ("medicare", "medicaid")),
)
TREATMENT_TYPE = (
    Rule("Imaging", "service_description", ("mri", "ct", "x-ray", "ultrasound", "imaging")),
    Rule("Medication", "service_description", (
        "injection", "inj", "tablet", "tb", "cp", "oral", "syrup", "mg", "solution", "suspension")),
    Rule("Procedure", "service_description", (
        "biopsy", "surgery", "resection", "repair", "ablation", "implant", "arthroplasty", "graft")),
    Rule("Lab Test", "service_description", (
        "panel", "ab/", "antibody", "lab", "urine", "test", "analysis", "level", "quant")),
    Rule("Supply/Device", "service_description", ("device", "supply", "graft", "stent", "pump", "dressing")),
)
DRUG_FORM = (
    Rule("Tablet", "service_description", ("tb", "tablet", "cp")),
    Rule("Injection", "service_description", ("inj", "injection", "ij")),
    Rule("Solution", "service_description", ("sol", "solution")),
    Rule("Topical", "service_description", ("cream", "ointment")),
    Rule("Inhaler", "service_description", ("inhalation", "ih", "is")),
)
IMAGING_TYPE = (
    Rule("MRI", "service_description", ("mri",)),
    Rule("CT Scan", "service_description", ("ct",)),
    Rule("X-Ray", "service_description", ("x-ray",)),
    Rule("Ultrasound", "service_description", ("ultrasound",)),
)
MEDICATION_TERMS = ("mg", "tb", "cp", "solution", "suspension", "syrup", "inhalation", "injection")
LAB_TEST_TERMS = ("panel", "antibody", "test", "level", "urine", "blood", "cbc", "cmp", "lipid")
BRAND_TERMS = ("stryker", "depuy", "bard", "zimmer", "philips", "medtronic", "covidien", "smith")

TEXT_COLUMNS = ("payer_name", "plan_name", "methodology", "service_description")


def contains_any(lowered: Column, terms: Sequence[str], whole_words: bool = False) -> Column:
    """Whether already lower-cased text holds any term; NULL text gives NULL.

    ``whole_words`` asks for the terms as words of their own, which stops "injection" counting as "ct".
    """
    # A term that holds a shorter one can add no match, unless words are compared.
    needed = [t for t in terms if whole_words or not any(other != t and other in t for other in terms)]
    if not whole_words:
        return reduce(or_, (F.contains(lowered, F.lit(term)) for term in needed))
    alternatives = "|".join(re.escape(term) for term in needed)
    return lowered.rlike(rf"(?<!\w)(?:{alternatives})(?!\w)")


def label_by(
    rules: Sequence[Rule],
    default: str | None,
    lowered: dict[str, Column],
    whole_words: bool = False,
) -> Column:
    """Label of the first rule that holds; ``lowered`` gives the lower-cased column for each name."""
    cases = F
    for rule in rules:
        cases = cases.when(contains_any(lowered[rule.column], rule.terms, whole_words), rule.label)
    return cases.otherwise(default)


def flag(lowered: Column, terms: Sequence[str], whole_words: bool = False) -> Column:
    """As ``contains_any``, but never NULL."""
    return F.coalesce(contains_any(lowered, terms, whole_words), F.lit(False))


def lower_texts(prefix: str = "") -> dict[str, Column]:
    """Lower-cased text columns; with a prefix, references to columns prepared under that prefix."""
    if prefix:
        return {name: F.col(prefix + name) for name in TEXT_COLUMNS}
    return {name: F.lower(name) for name in TEXT_COLUMNS}
