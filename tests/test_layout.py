"""Compaction: same rows, few partitions, pruned reads, interrupted at any point."""

import json
from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from test_operators import TYPE_1, TYPE_2

from chargelake.plans import jobs, layout
from chargelake.sinks.lakehouse import Lakehouse

MARCH, APRIL = datetime(2025, 3, 1, 12), datetime(2025, 4, 1, 12)


class Failing(Lakehouse):
    fails_at = None

    def append(self, table, df, partition_by=()):
        if table == self.fails_at:
            raise InterruptedError(table)
        super().append(table, df, partition_by)

    def drop_partitions(self, table, values):
        if f"drop {table}" == self.fails_at:
            raise InterruptedError(table)
        super().drop_partitions(table, values)


@pytest.fixture
def lake(spark, tmp_path):
    return Failing(spark, f"lake_{uuid4().hex[:10]}", str(tmp_path / "lake"))


@pytest.fixture
def deliver(tmp_path):
    def write(first, last, shape=TYPE_1):
        paths = []
        for number in range(first, last):
            path = tmp_path / "in" / f"h{number}.json"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(json.dumps(shape | {"pId": str(number % 3)}))
            paths.append(str(path))
        return paths

    return write


def rows(lake):
    return sorted(map(str, jobs.bronze_charges(lake).collect()))


def partitions(lake, table, *columns):
    return layout.partitions_of(lake, table, *columns)


def test_partitions_do_not_grow_with_files(lake, deliver):
    jobs.ingest(lake, deliver(0, 12), MARCH)
    before = rows(lake)
    assert partitions(lake, layout.LANDED, "source_id") == 12
    assert jobs.compact(lake) == 12 and rows(lake) == before
    assert partitions(lake, layout.COMPACTED, "bucket", "month") == 3 and partitions(lake, layout.LANDED, "source_id") == 0
    jobs.ingest(lake, deliver(12, 24), MARCH)
    more = rows(lake)
    assert len(more) == 2 * len(before)
    assert jobs.compact(lake) == 12 and rows(lake) == more and jobs.compact(lake) == 0
    assert partitions(lake, layout.COMPACTED, "bucket", "month") == 3
    files = lake.read(layout.COMPACTED).select(F.input_file_name().alias("f")).distinct().count()
    assert files == 3


def test_a_run_reads_its_own_partitions(lake, deliver):
    jobs.ingest(lake, deliver(0, 6), MARCH)
    jobs.compact(lake)
    jobs.ingest(lake, deliver(6, 12), APRIL)
    jobs.compact(lake)
    jobs.ingest(lake, deliver(12, 14, TYPE_2), APRIL)
    found = jobs.bronze_of_run(lake, MARCH)
    assert found.count() == 24 and jobs.bronze_of_run(lake, APRIL).count() == 26
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "2025-03" in plan.split("PartitionFilters: [")[-1] or any("2025-03" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
    jobs.refine(lake, APRIL)
    assert lake.read("silver_charges").count() > 0


@pytest.mark.parametrize("fails_at", [layout.COMPACTED, layout.MOVED, f"drop {layout.LANDED}"])
def test_interrupted_compaction_changes_nothing(lake, deliver, fails_at):
    jobs.ingest(lake, deliver(0, 4), MARCH)
    jobs.compact(lake)
    jobs.ingest(lake, deliver(4, 8), MARCH)
    before = rows(lake)
    lake.fails_at = fails_at
    if fails_at == layout.COMPACTED:
        lake.overwrite_partitions = lambda *_: (_ for _ in ()).throw(InterruptedError())
    with pytest.raises(InterruptedError):
        jobs.compact(lake)
    assert rows(lake) == before
    lake.fails_at = None
    lake.__dict__.pop("overwrite_partitions", None)
    jobs.compact(lake)
    assert rows(lake) == before and partitions(lake, layout.LANDED, "source_id") == 0


def test_unrecorded_files_stay_where_they_landed(lake, deliver, tmp_path):
    jobs.ingest(lake, deliver(0, 2), MARCH)
    (tmp_path / "in" / "bad.json").write_text("{")
    jobs.ingest(lake, str(tmp_path / "in"), MARCH)
    assert jobs.compact(lake) == 2 and partitions(lake, layout.LANDED, "source_id") == 1
    assert jobs.rejected_records(lake).count() == 1


def rows_scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark, lake):
    charges = spark.range(200_000).select(
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(2000))).alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("more"))
    charges = charges.withColumn("code", F.when(F.rand(1) < 0.3, "hot").otherwise(F.col("code")))
    lake.replace("plain", charges.repartition(4))
    lake.replace_indexed("indexed", charges, "code", distinct=500, group_bytes=256 << 10)
    for code in ("c17", "hot"):
        plain, indexed = (lake.read(table).filter(F.col("code") == code) for table in ("plain", "indexed"))
        assert sorted(indexed.collect()) == sorted(plain.collect())
    plain, indexed = (rows_scanned(lake.read(table).filter("code = 'c17'")) for table in ("plain", "indexed"))
    assert plain == 200_000 and indexed < 50_000
    sizes = lake.read("indexed").filter("code = 'hot'").groupBy(F.input_file_name()).count()
    assert sizes.count() > 1


def test_bloom_filters_skip_what_ranges_cannot(spark, tmp_path):
    rows = spark.range(100_000).select(F.concat(F.lit("c"), F.col("id") * 2).alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("more"))
    for name, options in {"with": {"parquet.bloom.filter.enabled#code": "true", "parquet.bloom.filter.expected.ndv#code": "100000", "parquet.enable.dictionary": "false"}, "without": {"parquet.enable.dictionary": "false"}}.items():
        rows.coalesce(1).write.options(**options).parquet(str(tmp_path / name))
    scanned = {name: rows_scanned(spark.read.parquet(str(tmp_path / name)).filter("code = 'c33333'")) for name in ("with", "without")}
    assert scanned["with"] == 0 and scanned["without"] > 0
