"""Scalar columns of the clean and silver layers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LOW_BELOW = 100
HIGH_ABOVE = 1000


def standardized(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def iso_date(name: str) -> Column:
    """Date from yyyy-MM-dd text; text in another form gives NULL."""
    return F.try_to_date(F.col(name), "yyyy-MM-dd")


def file_stem(name: Column) -> Column:
    """Table-style name of a file: base name without .json or .csv, lower case, blanks and dashes as underscores."""
    base = F.substring_index(name, "/", -1)
    for suffix in (".json", ".csv"):
        base = F.replace(base, F.lit(suffix), F.lit(""))
    return F.translate(F.lower(base), " -", "__")


def charge_bucket(amount: Column) -> Column:
    """Low below 100, Medium to 1000, High above (NaN sorts above all), Unknown without an amount."""
    return (
        F.when(amount.isNull(), "Unknown")
        .when(amount < LOW_BELOW, "Low")
        .when(amount <= HIGH_ABOVE, "Medium")
        .otherwise("High")
    )


def patient_amount() -> Column:
    return F.col("gross_charge") - F.col("standard_charge_dollar")


def payer_info_missing() -> Column:
    return F.isnull("payer_name") | F.isnull("plan_name") | F.isnull("methodology")


def address_columns(parts: Column, from_end: bool = False) -> dict[str, Column]:
    """Street, city, state and ZIP from a comma-split address.

    By default the first three parts are street, city and state with ZIP. ``from_end`` takes the last
    two as city and state with ZIP, so that a suite before the city does not shift them.
    """
    if from_end:
        count = F.size(parts)
        city, tail = F.get(parts, count - 2), F.get(parts, count - 1)
        street = F.array_join(F.slice(parts, 1, F.greatest(count - 2, F.lit(0))), ",")
    else:
        street, city, tail = (F.get(parts, F.lit(place)) for place in range(3))
    return {
        "street": F.trim(street),
        "city": F.trim(city),
        "state": F.regexp_extract(tail, "([A-Z]{2})", 1),
        "zip_code": F.regexp_extract(tail, r"(\d{5})", 1),
    }
