"""Files of bounded length, and files read in splits, on their way to bronze and silver."""

import gzip
import json
from contextlib import redirect_stdout
from datetime import datetime
from io import StringIO
from pathlib import Path
from types import SimpleNamespace
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from chargelake import fixtures
from chargelake.plans import jobs, queries
from chargelake.sinks.lakehouse import Lakehouse
from chargelake.sources import split_json
from chargelake.staging import staged

RUN_TS = datetime(2025, 3, 1, 12)


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, f"delivery_{uuid4().hex[:10]}", str(tmp_path / "lake"))


def explained(df):
    text = StringIO()
    with redirect_stdout(text):
        df.explain(True)
    return text.getvalue()


@pytest.mark.parametrize("count", [1, 6, 7])
def test_documents_go_into_arrays_of_bounded_length(spark, tmp_path, count):
    docs = spark.range(count, numPartitions=1).select(F.col("id").cast("string").alias("pId"))
    fixtures.write_documents(docs, str(tmp_path / "docs"), per_file=3)
    arrays = [json.loads(path.read_text()) for path in sorted((tmp_path / "docs").glob("part-*"))]
    assert [len(array) for array in arrays] == {1: [1], 6: [3, 3], 7: [3, 3, 1]}[count]
    assert [doc["pId"] for array in arrays for doc in array] == [str(i) for i in range(count)]


def test_one_file_per_task_on_request(spark, tmp_path):
    docs = spark.range(7, numPartitions=1).select(F.col("id").cast("string").alias("pId"))
    fixtures.write_documents(docs, str(tmp_path / "docs"), per_file=None)
    (path,) = (tmp_path / "docs").glob("part-*")
    assert len(json.loads(path.read_text())) == 7


def test_only_whole_files_are_spread(lake):
    files = [SimpleNamespace(source_path=f"file:/in/{name}", length=1000) for name in ("a.csv", "b.csv")]
    assert not jobs._outweighs(lake, files, whole=False)
    assert jobs._outweighs(lake, files, whole=True)
    packed = SimpleNamespace(source_path="file:/in/c.csv.GZ", length=1000)
    assert jobs._outweighs(lake, [*files, packed], whole=False)


def test_rows_of_split_files_are_not_shuffled(spark, lake, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        lines = [f"{name}{i},{i}" for i in range(20)] + ["cut"]
        (tmp_path / "in" / f"{name}.csv").write_text("\n".join(["description,standard_charge | gross", *lines]) + "\n")
    plans, write = [], Lakehouse.overwrite_partitions

    def overwrite(self, table, df, partition_by):
        plans.append(explained(df))
        write(self, table, df, partition_by)

    monkeypatch.setattr(Lakehouse, "overwrite_partitions", overwrite)
    assert jobs.ingest(lake, str(tmp_path / "in"), RUN_TS, file_format="csv") == 2
    assert plans and not any("Exchange" in plan for plan in plans)
    rows = jobs.bronze_charges(lake).groupBy("source_id").agg(F.sum("gross_charge").alias("sum"), F.count("*").alias("n"))
    assert [(row["sum"], row["n"]) for row in rows.collect()] == [(190.0, 20)] * 2
    assert jobs.rejected_records(lake).count() == 2


def test_silver_is_gathered_before_its_columns_are_added(spark, lake, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text(
        "provider_id,hospital_name,description,standard_charge | gross,standard_charge | min,standard_charge | max,"
        "standard_charge | negotiated_dollar\n1,A,MRI,9,1,9,5\n1,A,MRI,9,1,9,5\n")
    jobs.ingest(lake, str(tmp_path / "a.csv"), RUN_TS, file_format="csv")
    seen, enrich = [], jobs.enrich

    def watched(df, *more):
        seen.append(explained(df))
        return enrich(df, *more)

    monkeypatch.setattr(jobs, "enrich", watched)
    jobs.refine(lake, RUN_TS)
    assert "REBALANCE" in seen[0]


def test_delivered_files_are_packed_and_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "LINES_PER_FILE", 3)
    docs = spark.range(7, numPartitions=1).select(F.col("id").cast("string").alias("pId"))
    fixtures.write_documents(docs, str(tmp_path / "docs"), per_file=3, packed=True)
    rows = docs.select(F.col("pId").alias("code"), F.lit("a\nb").alias("service_description"))
    fixtures.write_csv(rows, str(tmp_path / "wide"))
    fixtures.write_lines(docs.select("pId"), str(tmp_path / "lines"))
    fixtures.write_lines(docs.select(F.concat("pId", F.lit(",x")).alias("value")), str(tmp_path / "headed"), "code,name")
    found = {}
    for name in ("docs", "wide", "lines", "headed"):
        paths = sorted((tmp_path / name).glob("part-*"))
        assert len(paths) == 3 and all(path.name.endswith(".gz") for path in paths)
        found[name] = [gzip.decompress(path.read_bytes()).decode() for path in paths]
    assert [len(json.loads(text)) for text in found["docs"]] == [3, 3, 1]
    assert all(text.startswith("code,name\n") for text in found["headed"])
    assert [line for text in found["headed"] for line in text.splitlines()[1:]] == [f"{i},x" for i in range(7)]
    assert "".join(found["lines"]).split() == [str(i) for i in range(7)]
    assert spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "wide")).count() == 7


@pytest.mark.parametrize("count", [0, 1, 7])
def test_one_file_is_strung_together_from_the_parts_of_many_tasks(spark, tmp_path, count):
    docs = spark.range(count, numPartitions=5).select(F.col("id").cast("string").alias("pId"), F.lit("ü").alias("hospital_name"))
    fixtures.write_one_file(docs, str(tmp_path / "docs"))
    (path,) = (tmp_path / "docs").glob("*.txt")
    assert sorted(doc["pId"] for doc in json.loads(path.read_text())) == [str(i) for i in range(count)]
    assert split_json.scan_split_documents(spark, str(tmp_path / "docs")).filter("reason IS NULL").count() == count


def test_stored_documents_go_once_they_are_delivered(spark, monkeypatch):
    kept = []

    def documents(spark, sf_dir):
        kept.append(staged(spark.range(5).select(F.col("id").cast("string").alias("pId"), F.lit("inpatient").alias("setting")), "documents"))
        return kept[-1]

    monkeypatch.setattr(fixtures, "documents", documents)
    (folder,) = queries._delivered(spark, "", "inpatient")
    assert spark.read.option("multiLine", True).json([folder, queries._all_documents(spark, "")]).count() == 10
    for docs in kept:
        assert not any(Path(path.removeprefix("file:")).exists() for path in docs.inputFiles())
