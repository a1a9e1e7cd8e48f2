"""From nested hospital documents and wide CSV rows to bronze: one row per item, code, charge and payer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chargelake import schemas
from chargelake.operators.lookup import lookup_join

# Ids of hospitals whose documents carry none.
KNOWN_HOSPITAL_IDS = {
    "Kindred Hospital Ontario": "106361274",
    "RIVERSIDE COMMUNITY HOSPITAL": "050022",
}
LITERAL_IDS = 1000

HEADER = (
    "hospital_id", "hospital_name", "hospital_address", "hospital_location",
    "last_updated_on", "license_number", "license_state",
)


def document_variant() -> Column:
    """1 or 2, the rules by which a document is flattened; NULL for what is no hospital document.

    The license field that has a value decides. A license under its third name goes with the first variant, as such
    documents share its form. Without any, a document with items is of the second variant, which drops nothing.
    """
    license_info = F.col("license_information")
    return (
        F.when(license_info["license"].isNotNull(), 1).when(license_info["license_number"].isNotNull(), 2)
        .when(license_info["hospital_license_number"].isNotNull(), 1)
        .when(F.col("standard_charge_information").isNotNull(), 2)
    )


def any_license() -> Column:
    """The license under any of its three names."""
    return F.coalesce(*(
        F.col(f"license_information.{name}") for name in ("license", "license_number", "hospital_license_number")
    ))


def with_hospital_ids(docs: DataFrame, known_ids: Mapping[str, str] | DataFrame = KNOWN_HOSPITAL_IDS) -> DataFrame:
    """Fill ``pId`` from ``provider_id``, then from a name-to-id mapping.

    A table (hospital_name, hospital_id), or a long mapping made into one, is joined; a short mapping is a literal.
    """
    if not isinstance(known_ids, DataFrame) and len(known_ids) > LITERAL_IDS:
        known_ids = docs.sparkSession.createDataFrame(list(known_ids.items()), "hospital_name string, hospital_id string")
    own_id = F.coalesce("pId", "provider_id")
    if isinstance(known_ids, DataFrame):
        named = known_ids.select("hospital_name", F.col("hospital_id").alias("_known_id"))
        found = lookup_join(docs, named, ["hospital_name"])
        return found.withColumn("pId", F.coalesce(own_id, "_known_id")).drop("_known_id")
    pairs = [F.lit(text) for pair in known_ids.items() for text in pair]
    by_name = F.element_at(F.create_map(*pairs), F.col("hospital_name")) if pairs else F.lit(None)
    return docs.withColumn("pId", F.coalesce(own_id, by_name))


def open_array(df: DataFrame, array: str, element: str, keep_empty: bool | Column) -> DataFrame:
    """One row per element. Rows with an empty or NULL array are kept with NULL, or dropped.

    A column decides it row by row, testing the array and not its elements, which may be NULL themselves.
    """
    others = [name for name in df.columns if name != array.split(".")[0]]
    if isinstance(keep_empty, Column):
        df, keep_empty = df.filter(keep_empty | (F.size(array) > 0)), True
    generator = F.explode_outer(array) if keep_empty else F.explode(array)
    return df.select(*others, generator.alias(element))


def document_header(docs: DataFrame, license_number: Column, extra: Iterable[str] = ()) -> DataFrame:
    return docs.select(
        *extra,
        F.coalesce("pId", "provider_id").alias("hospital_id"),
        "hospital_name",
        F.get("hospital_address", F.lit(0)).alias("hospital_address"),
        F.get("hospital_location", F.lit(0)).alias("hospital_location"),
        "last_updated_on",
        license_number.alias("license_number"),
        F.col("license_information.state").alias("license_state"),
        F.col("standard_charge_information").alias("items"),
    )


def code_charge_rows(headed: DataFrame, keep_empty: bool | Column, rebalance: bool = False) -> DataFrame:
    """Items, then codes times charges within each item.

    A document is one row in one task, however large; ``rebalance`` spreads its items over the cluster
    before the levels below multiply them.
    """
    items = open_array(headed, "items", "item", keep_empty)
    if rebalance:
        # By a number of their own: without a key Spark would sort whole items before it deals them out.
        items = items.withColumn("_place", F.monotonically_increasing_id()).hint("rebalance", "_place")
    head = [name for name in headed.columns if name != "items"]
    parts = items.select(
        *head,
        F.col("item.description").alias("service_description"),
        F.col("item.drug_information.type").alias("drug_type"),
        F.col("item.drug_information.unit").alias("drug_unit"),
        F.col("item.code_information").alias("codes"),
        F.col("item.standard_charges").alias("charges"),
    )
    coded = open_array(parts, "codes", "listed_code", keep_empty)
    charged = open_array(coded, "charges", "charge", keep_empty)
    return charged.select(
        *head, "service_description", "drug_type", "drug_unit",
        F.col("listed_code.code").alias("code"),
        F.col("listed_code.modifiers").alias("modifiers"),
        F.col("listed_code.type").alias("code_type"),
        F.col("charge.setting").alias("care_setting"),
        F.col("charge.gross_charge").alias("gross_charge"),
        F.col("charge.discounted_cash").alias("discounted_cash"),
        F.col("charge.minimum").alias("min_charge"),
        F.col("charge.maximum").alias("max_charge"),
        F.col("charge.payers_information").alias("payers"),
    )


def payer_rows(charges: DataFrame, keep_empty: bool | Column, dollar: Column | None = None) -> DataFrame:
    """All columns of both variants, one row per payer of each charge, plus the ``payer`` struct."""
    paid = open_array(charges, "payers", "payer", keep_empty)
    names = [name for name in paid.columns if name != "payer"]
    return paid.select(
        *names,
        *[F.col(f"payer.{name}").alias(name) for name in ("payer_name", "plan_name", "billing_class", "methodology")],
        (dollar if dollar is not None else F.col("payer.standard_charge_dollar")).alias("standard_charge_dollar"),
        *[
            F.col(f"payer.{name}").alias(name)
            for name in ("standard_charge_percentage", "additional_payer_notes", "standard_charge_algorithm")
        ],
        F.col("payer.pIdx").alias("payer_id"),
        "payer",
    )


def flatten_type1(docs: DataFrame, keep_payer_struct: bool = False, rebalance: bool = False) -> DataFrame:
    """First variant: a row needs an item, a code, a charge and a payer."""
    headed = document_header(docs, F.col("license_information.license"))
    rows = payer_rows(code_charge_rows(headed, False, rebalance), False)
    dropped = schemas.VARIANT_2_ONLY if keep_payer_struct else (*schemas.VARIANT_2_ONLY, "payer")
    return rows.drop(*dropped)


def flatten_type2(docs: DataFrame, rebalance: bool = False) -> DataFrame:
    """Second variant: empty levels stay as NULL; carries drug and payer-id columns."""
    headed = document_header(docs, F.col("license_information.license_number"))
    rows = payer_rows(code_charge_rows(headed, True, rebalance), True)
    return rows.drop(*schemas.VARIANT_1_ONLY, "payer")


def flatten_any_license(docs: DataFrame, known_ids: Mapping[str, str] | DataFrame = KNOWN_HOSPITAL_IDS) -> DataFrame:
    """First variant for documents in looser form: any license name, missing ids, estimated amounts."""
    headed = document_header(with_hospital_ids(docs, known_ids), any_license())
    dollar = F.coalesce("payer.standard_charge_dollar", "payer.estimated_amount")
    return payer_rows(code_charge_rows(headed, False), False, dollar).drop(*schemas.VARIANT_2_ONLY, "payer")


def flatten_documents(
    docs: DataFrame, extra: Sequence[str] = (), rebalance: bool = False, keep_unknown: bool = False,
    known_ids: Mapping[str, str] | DataFrame | None = None, estimates: bool = False,
) -> DataFrame:
    """Documents of both variants in one pass, as bronze rows.

    ``extra`` names further document columns to carry along. What is no hospital document gives no rows, or with
    ``keep_unknown`` one row each that has only header columns; ``document_variant`` tells them apart. ``known_ids``
    fills missing hospital ids by name, and ``estimates`` takes an estimated amount where no negotiated one is given.
    """
    variant = F.col("document_variant")
    tagged = docs if known_ids is None else with_hospital_ids(docs, known_ids)
    tagged = tagged.withColumn("document_variant", document_variant())
    if keep_unknown:
        extra = [*extra, "document_variant"]
    else:
        tagged = tagged.filter(variant.isNotNull())
    first, second = variant.eqNullSafe(1), variant.eqNullSafe(2)
    headed = document_header(tagged, any_license(), dict.fromkeys([*extra, "document_variant"]))
    dollar = F.coalesce("payer.standard_charge_dollar", "payer.estimated_amount") if estimates else None
    rows = payer_rows(code_charge_rows(headed, ~first, rebalance), ~first, dollar)
    owner = {name: second for name in schemas.VARIANT_2_ONLY} | {name: first for name in schemas.VARIANT_1_ONLY}
    return rows.select(
        *extra,
        *[F.when(owner[name], F.col(name)).alias(name) if name in owner else F.col(name) for name in schemas.BRONZE],
    )


def _groups(names: Iterable[str]) -> tuple[dict[str, dict[str, str]], dict[tuple[str, str], dict[str, str]]]:
    """The numbered codes and the payers' own columns of a wide header: per group, each part and its header name.

    Headers are compared without regard to case and to space around the bars.
    """
    codes: dict[str, dict[str, str]] = {}
    payers: dict[tuple[str, str], dict[str, str]] = {}
    for name in names:
        parts = [part.strip() for part in name.split("|")]
        kinds = [part.lower() for part in parts]
        if kinds[0] == "code" and len(parts) in (2, 3) and parts[1].isdigit() and kinds[2:] in ([], ["type"]):
            codes.setdefault(parts[1], {})["code_type" if kinds[2:] else "code"] = name
        elif kinds[0] == "standard_charge" and len(parts) == 4 and kinds[3] in schemas.CSV_PAYER_PARTS:
            payers.setdefault((parts[1], parts[2]), {})[schemas.CSV_PAYER_PARTS[kinds[3]]] = name
        elif kinds[0] in schemas.CSV_PAYER_PARTS and len(parts) == 3:
            payers.setdefault((parts[1], parts[2]), {})[schemas.CSV_PAYER_PARTS[kinds[0]]] = name
    return codes, payers


def align_csv_groups(wide: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Bronze columns from a wide CSV whose header repeats groups: a row per code and payer that a line has values for.

    Codes stand under ``code | n`` and ``code | n | type``; a payer's columns carry its name and plan in their header.
    A line without a code or without a value for any payer keeps one row with NULL there; one of whose payer columns
    are of the long form, ``payer_name`` and so on, keeps that payer beside the others.
    """
    codes, payers = _groups(wide.columns)
    base = align_csv(wide, extra=[*extra, *[F.col(f"`{name}`") for group in (*codes.values(), *payers.values()) for name in group.values() if name not in extra]])
    own = [name for name in schemas.BRONZE]
    coded = F.array(*[
        F.struct(*[(F.col(f"`{group[part]}`") if part in group else F.lit(None)).cast("string").alias(part) for part in ("code", "code_type")])
        for _, group in sorted(codes.items(), key=lambda pair: int(pair[0]))
    ]) if codes else None
    paid = F.array(*[
        F.struct(F.lit(payer).alias("payer_name"), F.lit(plan).alias("plan_name"), *[
            (F.col(f"`{group[part]}`").try_cast(schemas.BRONZE.get(part, "double")) if part in group else F.lit(None).cast(schemas.BRONZE.get(part, "double"))).alias(part)
            for part in schemas.CSV_PAYER_PARTS.values()])
        for (payer, plan), group in payers.items()
    ]) if payers else None

    rows, replaced = base, {}
    if coded is not None:
        given = F.filter(coded, lambda one: one["code"].isNotNull())
        rows = rows.withColumn("_code", F.explode_outer(given))
        replaced |= {part: F.col(f"_code.{part}") for part in ("code", "code_type")}
    if paid is not None:
        given = F.filter(paid, lambda one: F.coalesce(*[one[part].cast("string") for part in schemas.CSV_PAYER_PARTS.values()]).isNotNull())
        parts = ("payer_name", "plan_name", *[part for part in schemas.CSV_PAYER_PARTS.values() if part in schemas.BRONZE])
        long_form = F.array(F.struct("payer_name", "plan_name", *[
            F.col(part) if part in schemas.BRONZE else F.lit(None).cast("double").alias(part) for part in schemas.CSV_PAYER_PARTS.values()]))
        kind = f"array<{rows.select(given.alias('given')).schema['given'].dataType.elementType.simpleString()}>"
        given = F.concat(F.when(F.col("payer_name").isNotNull(), long_form.cast(kind)).otherwise(F.array().cast(kind)), given)
        rows = rows.withColumn("_payer", F.explode_outer(given))
        stated = F.col("_payer").isNotNull()
        replaced |= {part: F.when(stated, F.col(f"_payer.{part}")).otherwise(F.col(part)) for part in parts}
        replaced["standard_charge_dollar"] = F.coalesce(replaced["standard_charge_dollar"], F.col("_payer.estimated_amount"))
    return rows.select(*extra, *[replaced[name].alias(name) if name in replaced else F.col(name) for name in own])


def align_csv(wide: DataFrame, truncate_cents: bool = False, extra: Sequence[str | Column] = ()) -> DataFrame:
    """Bronze columns from a wide CSV read as text. Numbers that do not parse give NULL.

    ``truncate_cents`` cuts negotiated, least and greatest amounts to whole dollars.
    """
    cut = {"min_charge", "max_charge", "standard_charge_dollar", "standard_charge_percentage"}
    present = set(wide.columns)
    columns = []
    for name, dtype in schemas.BRONZE.items():
        header = schemas.CSV_HEADERS.get(name)
        value = F.col(f"`{header}`") if header in present else F.lit(None)
        value = value.try_cast(dtype)
        if truncate_cents and name in cut:
            value = value.try_cast("bigint").cast("double")
        columns.append(value.alias(name))
    return wide.select(*extra, *columns)
