"""Bronze to clean rows: required values, duplicates, standard text, plausible amounts, imputation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from chargelake.functions.columns import iso_date, standardized
from chargelake.staging import fits_broadcast, staged

# The columns that each cleaning mode requires.
REQUIRED_STRICT = ("hospital_id", "hospital_name", "service_description", "gross_charge", "standard_charge_dollar")
REQUIRED_RANGE = ("min_charge", "max_charge")
REQUIRED_IMPUTED = ("hospital_id", "hospital_name", "service_description", "gross_charge")

ROWS_COMPARED = 1 << 27  # rows shuffled at once to be compared whole


def drop_missing(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(required))


def standardize(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "payer_name": standardized("payer_name"),
        "plan_name": standardized("plan_name"),
        "last_updated_on": iso_date("last_updated_on"),
    })


STANDARDIZED = ("payer_name", "plan_name", "last_updated_on")


def keep_consistent(df: DataFrame) -> DataFrame:
    """Positive gross charge, ordered range, no standard amount above gross; a NULL fails the test."""
    return df.filter(
        "gross_charge > 0 AND min_charge <= max_charge AND standard_charge_dollar <= gross_charge"
    )


def impute_gross(df: DataFrame) -> DataFrame:
    middle = (F.col("min_charge") + F.col("max_charge")) / 2
    return df.withColumn("gross_charge", F.coalesce("gross_charge", middle))


def impute_from_gross(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.coalesce(name, "gross_charge") for name in names})


def distinct_rows(df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """One of each group of rows that are equal in ``by``, by default in all columns; ``by`` must decide the others.

    Rows are stored once with a hash of ``by``, and hashes are counted. A hash that comes once tells that its row does,
    so only rows of other hashes are compared and shuffled, or all if those are too many to be broadcast. All are compared
    by slices of their hash, one after the other, so the disk holds the shuffle of one slice at a time. The result
    is cheap to read more than once.
    """
    mark, by = "_row_hash", list(by or df.columns)
    hashed = staged(df.withColumn(mark, F.xxhash64(*[F.col(f"`{name}`") for name in by])), "rows", "zstd")
    counted = hashed.groupBy(mark).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = staged(counted.filter("_rows > 1").select(mark), "repeated")
    if repeated.isEmpty():
        return hashed.drop(mark)
    if not fits_broadcast(repeated):
        slices = -(-hashed.count() // ROWS_COMPARED)
        compared = [
            staged(hashed.filter(F.pmod(mark, F.lit(slices)) == place).drop(mark).dropDuplicates(by), "distinct", "zstd")
            for place in range(slices)]
        return reduce(DataFrame.unionAll, compared)
    once, again = (hashed.join(F.broadcast(repeated), mark, how).drop(mark) for how in ("left_anti", "left_semi"))
    return once.unionAll(staged(again.dropDuplicates(by), "distinct", "zstd"))


def clean_strict(
    df: DataFrame, dedup_after_standardize: bool = False, then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Drop what is incomplete, repeated or implausible.

    Only amounts decide plausibility and cleaning leaves them alone, so that filter runs first and fewer
    rows reach the deduplication. By default rows count as repeated before
    their text is standardized; ``dedup_after_standardize`` also removes those that differ only in case
    or blanks. ``then`` adds columns that each row decides; they are stored with the rows, which saves writing them twice.
    """
    plausible = df.transform(drop_missing, REQUIRED_STRICT).transform(keep_consistent)
    raw = {} if dedup_after_standardize else {name: f"_raw_{name}" for name in STANDARDIZED}
    rows = plausible.withColumns({kept: F.col(name) for name, kept in raw.items()}).transform(standardize)
    rows = distinct_rows(then(rows) if then else rows, [raw.get(name, name) for name in df.columns])
    return rows.drop(*raw.values())


def clean_impute(df: DataFrame) -> DataFrame:
    """Fill missing amounts from the range and the gross charge instead of dropping the rows."""
    return (
        df.transform(drop_missing, REQUIRED_RANGE)
        .transform(impute_gross)
        .transform(impute_from_gross, "standard_charge_dollar", "discounted_cash")
        .transform(drop_missing, REQUIRED_IMPUTED)
        .transform(distinct_rows)
        .transform(standardize)
    )


CLEANERS = {"strict": clean_strict, "impute": clean_impute}


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, most first; NaN counts as missing. One pass over the data."""
    floating = (T.DoubleType, T.FloatType)
    counts = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        missing = column.isNull()
        if isinstance(field.dataType, floating):
            missing = missing | F.isnan(column)
        counts.append(F.count_if(missing).alias(field.name))
    profile = df.agg(*counts).unpivot([], df.columns, "column_name", "missing_count")
    return profile.orderBy(F.desc("missing_count"), "column_name")
