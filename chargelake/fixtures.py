"""Charges and hospital documents derived from the order tables, for queries, tests and timings."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chargelake import schemas
from chargelake.staging import scratch_path, staged

# The same text runs on Spark and on DuckDB; table names are put in for the braces.
CHARGES_SQL = """
SELECT l_orderkey, l_linenumber,
  CAST(s_suppkey AS STRING) AS hospital_id, s_name AS hospital_name,
  CASE s_suppkey % 4 WHEN 0 THEN '100 Main St, San Antonio, TX 78205' WHEN 1 THEN ' 7 Oak Ave , Ontario , CA 91762-1234 '
    WHEN 2 THEN '9 Elm Rd, Austin' ELSE '5 Pine Blvd, Suite 2, Houston, TX 77001' END AS hospital_address,
  CASE WHEN o_orderkey % 97 = 0 THEN '03/01/2025' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS last_updated_on,
  CONCAT('LIC-', CAST(s_suppkey AS STRING)) AS license_number, 'TX' AS license_state,
  CASE p_partkey % 16 WHEN 0 THEN 'MRI BRAIN W/O CONTRAST' WHEN 1 THEN 'CT HEAD' WHEN 2 THEN 'X-RAY CHEST 2 VIEWS'
    WHEN 3 THEN 'ULTRASOUND ABDOMEN' WHEN 4 THEN 'HEPARIN INJ 5000 UNITS' WHEN 5 THEN 'IBUPROFEN 200 MG TABLET'
    WHEN 6 THEN 'SALINE SOLUTION' WHEN 7 THEN 'KNEE ARTHROPLASTY STRYKER' WHEN 8 THEN 'LIVER BIOPSY'
    WHEN 9 THEN 'LIPID PANEL' WHEN 10 THEN 'URINE ANALYSIS' WHEN 11 THEN 'WOUND DRESSING'
    WHEN 12 THEN 'HYDROCORTISONE CREAM' WHEN 13 THEN 'ALBUTEROL INHALATION' WHEN 14 THEN 'ROOM AND BOARD'
    ELSE 'MEDTRONIC PUMP' END AS service_description,
  CAST(p_partkey AS STRING) AS code, CASE WHEN p_partkey % 5 = 0 THEN '26' END AS modifiers,
  CASE WHEN p_partkey % 2 = 0 THEN 'CPT' ELSE 'HCPCS' END AS code_type,
  CASE l_linestatus WHEN 'O' THEN 'outpatient' ELSE 'inpatient' END AS care_setting,
  CASE c_custkey % 8 WHEN 0 THEN ' Aetna Medicare' WHEN 1 THEN 'cigna ' WHEN 2 THEN 'Devoted Health' WHEN 3 THEN 'Molina'
    WHEN 4 THEN 'Self Pay' WHEN 5 THEN 'Medicaid TX' WHEN 6 THEN NULL ELSE 'Oscar' END AS payer_name,
  CASE o_orderkey % 7 WHEN 0 THEN 'gold hmo' WHEN 1 THEN 'Silver PPO' WHEN 2 THEN 'HIX Bronze' WHEN 3 THEN 'Medicare Adv'
    WHEN 4 THEN NULL WHEN 5 THEN 'Blue Advantage' ELSE 'Indemnity' END AS plan_name,
  CASE l_linenumber WHEN 1 THEN 'Case Rate' WHEN 2 THEN 'Fee Schedule' WHEN 3 THEN 'percent of total billed charges'
    WHEN 4 THEN NULL ELSE 'Per Diem' END AS methodology,
  'facility' AS billing_class,
  CASE WHEN l_quantity = 50 THEN NULL ELSE l_extendedprice / 50 END AS gross_charge,
  CASE WHEN l_quantity = 48 THEN NULL ELSE l_extendedprice / 60 END AS discounted_cash,
  CASE WHEN l_quantity = 49 THEN NULL ELSE l_extendedprice / 100 END AS min_charge,
  CASE WHEN l_tax = 0.08 THEN l_extendedprice / 200 ELSE l_extendedprice / 55 END AS max_charge,
  CASE WHEN l_quantity = 47 THEN NULL WHEN l_quantity = 1 THEN l_extendedprice
    ELSE l_extendedprice / 50 * (1 - l_discount) END AS standard_charge_dollar,
  CASE WHEN l_linenumber = 3 THEN l_discount * 100 END AS standard_charge_percentage
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
  JOIN {supplier} ON l_suppkey = s_suppkey JOIN {part} ON l_partkey = p_partkey
"""
TABLES = ("lineitem", "orders", "customer", "supplier", "part")
ORDER_COLUMNS = ("l_orderkey", "l_linenumber")
DOCUMENTS_PER_FILE = LINES_PER_FILE = 50_000
COPIED_BYTES = 4 << 20
# Delivered files repeat their names in each line. A packed file is read by one task, so none may be long.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a scan has fewer splits than there are cores; else as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def joined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joins of ``CHARGES_SQL``, in an order that sends few and narrow rows.

    Orders meet their customers before the many lines, and texts join the lines last.
    """
    scans = {name: table(spark, sf_dir, name) for name in TABLES}
    ordered = scans["orders"].join(scans["customer"], F.col("o_custkey") == F.col("c_custkey"))
    lines = spread(scans["lineitem"]).join(scans["part"], F.col("l_partkey") == F.col("p_partkey"))
    placed = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    return placed.join(scans["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))


def charges(spark: SparkSession, sf_dir: str, order_columns: bool = False) -> DataFrame:
    columns, _ = CHARGES_SQL.split("FROM {lineitem}")
    rows = spark.sql(columns + "FROM {joined}", joined=joined_orders(spark, sf_dir))
    return rows if order_columns else rows.drop(*ORDER_COLUMNS)


def _listed(first: Column, second: Column, empty: Column, both: Column, element_type: str) -> Column:
    """No element, both, or only the first."""
    length = F.when(empty, 0).when(both, 2).otherwise(1)
    return F.slice(F.array(first, second), F.lit(1), length).cast(f"array<{element_type}>")


def with_payers(row: DataFrame) -> DataFrame:
    """Add the payer list of each charge: none, its payer, or its payer and an uninsured price."""
    line, none = F.col("l_linenumber"), F.lit(None)
    own = F.struct(
        "payer_name", "plan_name", "billing_class", "methodology",
        F.when(line != 5, F.col("standard_charge_dollar")).alias("standard_charge_dollar"),
        F.when(line == 5, F.col("standard_charge_dollar")).alias("estimated_amount"),
        "standard_charge_percentage",
        F.when(line == 6, "see contract").alias("additional_payer_notes"),
        F.when(line == 3, "fee x 2").alias("standard_charge_algorithm"),
        F.concat(F.lit("P"), line.cast("string")).alias("pIdx"),
    )
    uninsured = F.struct(
        F.lit("Uninsured").alias("payer_name"), none.alias("plan_name"), F.lit("facility").alias("billing_class"),
        F.lit("Case Rate").alias("methodology"), F.col("discounted_cash").alias("standard_charge_dollar"),
        none.alias("estimated_amount"), none.alias("standard_charge_percentage"),
        none.alias("additional_payer_notes"), none.alias("standard_charge_algorithm"), F.lit("P0").alias("pIdx"),
    )
    return row.withColumn("payers", _listed(own, uninsured, F.col("payer_name").isNull(), line == 4, schemas.PAYER))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small hospital document around each charge, covering both variants and every kind of empty level.

    Built row by row, so that no hospital's charges meet in one task, and staged, as documents are read
    from storage; what writes them elsewhere can do so within ``released``. ``setting`` tells deliveries apart.
    """
    row = with_payers(charges(spark, sf_dir, order_columns=True))
    code, line = F.col("code").cast("int"), F.col("l_linenumber")
    kind = F.col("hospital_id").cast("int") % 10

    def charge(setting: Column, times: int) -> Column:
        return F.struct(
            setting.alias("setting"), (F.col("gross_charge") * times).alias("gross_charge"), "discounted_cash",
            F.col("min_charge").alias("minimum"), F.col("max_charge").alias("maximum"),
            F.col("payers").alias("payers_information"),
        )

    def listed_code(number: Column, modifiers: Column, system: Column) -> Column:
        return F.struct(number.alias("code"), modifiers.alias("modifiers"), system.alias("type"))

    item = F.struct(
        F.col("service_description").alias("description"),
        F.struct(F.lit("ML").alias("type"), F.col("modifiers").alias("unit")).alias("drug_information"),
        _listed(
            listed_code(F.col("code"), F.col("modifiers"), F.col("code_type")),
            listed_code(F.concat(F.lit("N"), F.col("code")), F.lit(None), F.lit("NDC")),
            code % 13 == 0, code % 3 == 0, schemas.CODE,
        ).alias("code_information"),
        _listed(
            charge(F.col("care_setting"), 1), charge(F.lit("both"), 2), line == 7, line == 2, schemas.CHARGE
        ).alias("standard_charges"),
    )
    items = F.when(F.col("l_orderkey") % 11 == 0, F.array()).otherwise(F.array(item))
    built = row.select(
        F.when(kind % 3 != 0, F.col("hospital_id")).alias("pId"),
        F.when(kind == 3, F.col("hospital_id")).alias("provider_id"),
        "hospital_name",
        F.array("hospital_address").alias("hospital_address"),
        F.when(kind == 2, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat("hospital_name", F.lit(" campus")))).alias("hospital_location"),
        "last_updated_on",
        F.struct(
            F.when(kind < 5, F.col("license_number")).alias("license"),
            F.when((kind >= 5) & (kind < 9), F.col("license_number")).alias("license_number"),
            F.when(kind == 9, F.col("license_number")).alias("hospital_license_number"),
            F.col("license_state").alias("state"),
        ).alias("license_information"),
        items.cast(f"array<{schemas.ITEM}>").alias("standard_charge_information"),
        F.col("care_setting").alias("setting"),
    )
    return staged(built, "documents", "zstd")


def write_documents(docs: DataFrame, path: str, per_file: int | None = DOCUMENTS_PER_FILE, packed: bool = False) -> None:
    """Write documents as files that hold one array each, over several lines; None for one file per task.

    The writer begins a new file after as many lines as a full array has, its two brackets included.
    """

    def as_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        yield pa.RecordBatch.from_pydict({"value": ["["]})
        for batch in batches:
            lines = batch.column(0).cast(pa.string())
            while len(lines):
                if held == per_file:
                    yield pa.RecordBatch.from_pydict({"value": ["]", "["]})
                    held = 0
                part = lines if per_file is None else lines[: per_file - held]
                yield _with_commas(part, held)
                held, lines = held + len(part), lines[len(part):]
        yield pa.RecordBatch.from_pydict({"value": ["]"]})

    writer = _document_lines(docs).mapInArrow(as_arrays, "value string").write.options(**PACKED if packed else {})
    writer.option("maxRecordsPerFile", 0 if per_file is None else per_file + 2).text(path)


def _document_lines(docs: DataFrame) -> DataFrame:
    return docs.select(F.to_json(F.struct(*[name for name in docs.columns if name != "setting"])).alias("value"))


def _with_commas(lines: pa.Array, held: int) -> pa.RecordBatch:
    """Lines as elements of an array that holds some already."""
    marks = pa.array(["," if held else ""] + [","] * (len(lines) - 1))
    return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, lines, "")], ["value"])


def write_one_file(docs: DataFrame, path: str) -> None:
    """Write all documents as one plain file that holds one array.

    Tasks write its parts. The driver strings them together as bytes, a part at a time, and deletes each that it has
    copied, so neither one task nor the disk has to hold the documents twice.
    """

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        for batch in batches:
            if batch.num_rows:
                yield _with_commas(batch.column(0).cast(pa.string()), held)
                held += batch.num_rows

    spark, parts = docs.sparkSession, scratch_path(docs.sparkSession, "parts")
    _document_lines(docs).mapInArrow(elements, "value string").write.text(parts)
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    folder = hadoop.fs.Path(parts)
    store = folder.getFileSystem(conf)
    names = [found.getPath() for found in store.listStatus(folder) if found.getLen() and found.getPath().getName().startswith("part-")]
    out = store.create(hadoop.fs.Path(f"{path}/documents.txt"))
    try:
        out.write(b"[\n")
        for place, name in enumerate(names):
            if place:
                out.write(b",\n")
            part = store.open(name)
            try:
                hadoop.io.IOUtils.copyBytes(part, out, COPIED_BYTES, False)
            finally:
                part.close()
            store.delete(name, False)
        out.write(b"]\n")
    finally:
        out.close()
    store.delete(folder, True)


def write_lines(lines: DataFrame, path: str, head: str | None = None) -> None:
    """Write the one column of ``lines`` as packed text files, or with a ``head`` as CSV files that each begin with it."""

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = LINES_PER_FILE
        for batch in batches:
            rest = batch.column(0).cast(pa.string())
            while len(rest):
                if held == LINES_PER_FILE:
                    yield pa.RecordBatch.from_pydict({"value": [head]})
                    held = 0
                part = rest[: LINES_PER_FILE - held]
                yield pa.RecordBatch.from_arrays([part], ["value"])
                held, rest = held + len(part), rest[len(part):]

    if head is not None:
        lines = lines.mapInArrow(headed, "value string")
    writer = lines.write.options(maxRecordsPerFile=LINES_PER_FILE + (head is not None), **PACKED)
    if head is None:
        writer.text(path)
    else:
        # Lines that are CSV already: no separator or quote in them means anything here.
        writer.options(sep="\x01", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """Write charges as packed files of wide CSV under the published header names."""
    headers = {name: header for name, header in schemas.CSV_HEADERS.items() if name in rows.columns}
    rows.select(*[F.col(name).alias(header) for name, header in headers.items()]).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, maxRecordsPerFile=LINES_PER_FILE, **PACKED
    ).csv(path)
