"""Jobs and sinks: repeated runs, refused files, rejected documents, exports."""

import json
from datetime import datetime
from types import SimpleNamespace
from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from test_operators import TYPE_1, TYPE_2, UNKNOWN

from chargelake import staging
from chargelake.operators.score import with_price_rank
from chargelake.plans import jobs
from chargelake.sinks.export import DIMENSIONS, JdbcTarget, export_gold
from chargelake.sinks.lakehouse import Lakehouse
from chargelake.sources.tables import describe_columns, high_mark
from chargelake.streaming.pickup import start_pickup

FIRST, SECOND = datetime(2025, 3, 1, 12, 0, 0, 500_000), datetime(2025, 3, 1, 12, 0, 0, 750_000)


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, f"lake_{uuid4().hex[:10]}", str(tmp_path / "lake"))


@pytest.fixture
def deliver(tmp_path):
    def write(name, content):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(content, indent=1))
        return str(path)

    return write


@pytest.fixture
def target(spark, tmp_path):
    """Takes exports in place of a database."""
    return Lakehouse(spark, f"target_{uuid4().hex[:10]}", str(tmp_path / "target"))


def test_run_twice_adds_and_exports_nothing_more(lake, target, deliver):
    paths = [deliver("Santa Rosa-TX.json", TYPE_1), deliver("B.json", TYPE_2)]
    assert jobs.run_all(lake, paths, FIRST, target) == 2
    counts = {t: lake.read(t).count() for t in (*DIMENSIONS, "fact_charges", "silver_charges")}
    assert counts["fact_charges"] == counts["silver_charges"] == 4
    assert jobs.run_all(lake, paths, SECOND, target) == 0
    jobs.build_gold(lake, jobs.rows_of_run(lake, lake.read("silver_charges"), FIRST), FIRST)
    assert counts == {t: lake.read(t).count() for t in counts}
    assert target.read("fact_charges").count() == 4
    assert not export_gold(lake, target)
    assert {r.source_name for r in lake.read(jobs.REGISTRY).collect()} == {"santa_rosa_tx", "b"}


def test_later_delivery_is_exported_alone(lake, target, deliver):
    jobs.run_all(lake, deliver("a.json", TYPE_1), FIRST, target)
    again = json.loads(json.dumps(TYPE_1).replace('"P"', '"R"'))
    jobs.run_all(lake, deliver("b.json", again), SECOND, target)
    assert target.read("fact_charges").groupBy("gold_ingestion_ts").count().orderBy("gold_ingestion_ts").collect() == [
        (FIRST, 4), (SECOND, 4)]
    assert sorted(lake.read("dim_payer").collect()) == [(1, "P"), (2, "Q"), (3, "R")]
    facts = lake.read("fact_charges")
    assert facts.count() == 8 and facts.filter("payer_id IS NULL").isEmpty()


def test_ingest_repeated_before_it_was_recorded(lake, deliver):
    path = deliver("a.json", TYPE_1)
    jobs.ingest(lake, path, FIRST)
    lake.drop([jobs.REGISTRY])
    jobs.ingest(lake, path, SECOND)
    assert lake.read("bronze_charges").count() == 4


def test_known_and_same_named_files(lake, deliver):
    first = deliver("a.json", TYPE_1)
    jobs.ingest(lake, first, FIRST)
    assert jobs.ingest(lake, first, SECOND) == 0
    with pytest.raises(ValueError, match="before"):
        jobs.ingest(lake, first, SECOND, on_known="error")
    others = [deliver("other/A.json", TYPE_1), deliver("x/n.json", TYPE_1), deliver("y/N.json", TYPE_1)]
    for some in (others[:1], others[1:]):
        with pytest.raises(ValueError, match="same name"):
            jobs.ingest(lake, some, SECOND)
    assert jobs.ingest(lake, [*others, deliver("z.json", TYPE_2)], SECOND, on_conflict="reject") == 1
    rejected = lake.read(jobs.REJECTED_FILES)
    assert sorted(r.source_name for r in rejected.collect()) == ["a", "n", "n"]
    assert lake.read("bronze_charges").count() == 5


def test_mixed_folder_and_repaired_file(lake, deliver, tmp_path):
    deliver("a.json", TYPE_1)
    broken = tmp_path / "in" / "b.json"
    broken.write_text(json.dumps(TYPE_2)[:40])
    (tmp_path / "in" / "c.csv").write_text("description,provider_id,standard_charge | gross\nKnee,9,12.5\n")
    folder = str(tmp_path / "in")
    assert jobs.ingest(lake, folder, FIRST) == 1
    assert jobs.ingest(lake, folder, FIRST, file_format="csv") == 1
    assert [r.source_name for r in lake.read(jobs.REJECTED_FILES).collect()] == ["b"]
    broken.write_text(json.dumps(TYPE_2))
    assert jobs.ingest(lake, folder, SECOND) == 1
    assert jobs.bronze_charges(lake).count() == 6 and jobs.rejected_documents(lake).isEmpty()
    assert jobs.hospital_ingested(lake, "9") and not jobs.hospital_ingested(lake, "404")


def test_csv_options_reach_the_reader(lake, deliver, tmp_path):
    (tmp_path / "w.csv").write_text('description,provider_id,standard_charge | gross\n"two\nlines",9,12.5\n')
    assert jobs.ingest(lake, str(tmp_path / "w.csv"), FIRST, file_format="csv", csv_options={"multiLine": "true"}) == 1
    assert [r.service_description for r in jobs.bronze_charges(lake).collect()] == ["two\nlines"]


def test_repeated_refine_leaves_no_stale_rows(lake, deliver):
    text = json.dumps(TYPE_1).replace('"gross_charge"', '"other"')
    jobs.ingest(lake, [deliver("a.json", json.loads(text)), deliver("b.json", TYPE_1)], FIRST)
    jobs.refine(lake, FIRST, "impute")
    jobs.refine(lake, FIRST, "strict")
    strict = lake.read("silver_charges")
    assert strict.filter("gross_charge IS NULL").isEmpty()
    assert {r.source_id.split("-")[0] for r in strict.select("source_id").collect()} == {"b"}


def test_unknown_documents_are_kept_aside(lake, deliver):
    jobs.ingest(lake, deliver("a.json", [TYPE_1, UNKNOWN]), FIRST)
    assert jobs.bronze_charges(lake).count() == 4
    assert [r.hospital_id for r in jobs.rejected_documents(lake).collect()] == ["3"]
    with pytest.raises(ValueError, match="known variant"):
        jobs.ingest(lake, deliver("b.json", UNKNOWN), SECOND, on_unknown="error")


def test_documents_and_csv_share_bronze(lake, deliver, tmp_path):
    jobs.ingest(lake, deliver("a.json", TYPE_1), FIRST)
    (tmp_path / "Vernon Memorial.csv").write_text("description,provider_id,standard_charge | gross\nKnee,9,12.5\nHip,9,\n")
    assert jobs.ingest(lake, str(tmp_path / "Vernon Memorial.csv"), SECOND, file_format="csv") == 1
    added = jobs.rows_of_run(lake, jobs.bronze_charges(lake), SECOND)
    assert sorted((r.service_description, r.gross_charge) for r in added.collect()) == [("Hip", None), ("Knee", 12.5)]
    assert jobs.bronze_charges(lake).count() == 6 and jobs.rejected_documents(lake).isEmpty()
    assert {r.source_name for r in lake.read(jobs.REGISTRY).collect()} == {"a", "vernon_memorial"}


def test_stream_takes_each_file_once(lake, deliver, tmp_path):
    def pick_up():
        start_pickup(lake, str(tmp_path / "in"), str(tmp_path / "checkpoint")).awaitTermination()
        return lake.read("bronze_charges").count()

    deliver("a.json", TYPE_1)
    assert [pick_up(), pick_up()] == [4, 4]
    deliver("b.json", TYPE_2)
    assert pick_up() == 5


def test_columns_are_described(spark, lake):
    lake.replace("b", spark.sql("SELECT 1 AS x, current_timestamp() AS at"))
    lake.replace("a", spark.sql("SELECT array('p') AS list"))
    assert [tuple(r) for r in describe_columns(spark, lake.namespace).collect()] == [
        ("a", 1, "list", "array<string>"), ("b", 1, "x", "int"), ("b", 2, "at", "timestamp")]


def test_appends_match_by_name(spark, lake):
    lake.append("t", spark.sql("SELECT 1 AS a, 'x' AS b"))
    lake.append("t", spark.sql("SELECT 'y' AS b, 2 AS a"))
    assert sorted(lake.read("t").collect()) == [(1, "x"), (2, "y")]
    lake.replace("t", spark.sql("SELECT 3 AS a"))
    assert lake.read("t").columns == ["a"]


def test_only_given_partitions_are_overwritten(spark, lake):
    lake.overwrite_partitions("t", spark.sql("SELECT * FROM VALUES (1, 'p'), (2, 'q') AS t(a, p)"), ["p"])
    lake.overwrite_partitions("t", spark.sql("SELECT 'q' AS p, 3 AS a"), ["p"])
    assert sorted(lake.read("t").select("a", "p").collect()) == [(1, "p"), (3, "q")]


def test_watermark_keeps_microseconds_and_prunes(spark, lake):
    stamped = spark.createDataFrame([(1, FIRST), (2, SECOND)], "a int, gold_ingestion_ts timestamp")
    lake.replace("fact_charges", stamped, ["gold_ingestion_ts"])
    lake.advance_watermark("fact_charges", stamped.filter("a = 1"), "gold_ingestion_ts")
    pending = lake.pending("fact_charges", "gold_ingestion_ts")
    assert [r.a for r in pending.collect()] == [2]
    assert "PartitionFilters: [isnotnull(gold_ingestion_ts" in pending._jdf.queryExecution().toString()
    assert high_mark(stamped.limit(0), "gold_ingestion_ts") is None


def test_jdbc_options_carry_no_fixed_login():
    options = JdbcTarget("jdbc:x:y", "gold", {"user": "u", "driver": "d"}, connections=4).options("dim_plan")
    assert options["dbtable"] == "gold.dim_plan" and options["numPartitions"] == "4" and options["user"] == "u"
    assert "password" not in options


def test_scratch_follows_the_cluster_setting(monkeypatch):
    def session(folder, master):
        context = SimpleNamespace(master=master, applicationId="app")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=context)

    prepared = []
    monkeypatch.setattr(staging, "_prepare", lambda _, folder: prepared.append(folder))
    for _ in range(2):
        assert staging.scratch_path(session("s3://shared/", "yarn"), "x").startswith("s3://shared/chargelake/app/x-")
    assert prepared == ["s3://shared/chargelake/app"]
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.scratch_path(session(None, "yarn"), "x")


def test_size_check_measures_text(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert staging.fits_broadcast(df, 200_000) and not staging.fits_broadcast(df, 100_000)
    assert staging.fits_broadcast(df.limit(0), 0)


def test_ranking_reads_only_its_columns(spark, tmp_path):
    wide = spark.range(50).select(
        F.lit("s").alias("service_description"), F.col("id").cast("double").alias("standard_charge_dollar"),
        F.lit("unused").alias("other"))
    wide.write.parquet(str(tmp_path / "wide"))
    ranked = with_price_rank(spark.read.parquet(str(tmp_path / "wide"))).select("price_rank")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_broken_records_keep_their_text_and_reason(lake, deliver, tmp_path):
    folder = tmp_path / "in"
    deliver("a.json", TYPE_1)
    (folder / "b.json").write_text(json.dumps(TYPE_2)[:60])
    (folder / "c.csv").write_text("description,provider_id,standard_charge | gross\nKnee,9,12.5\nHip, with comma,9,3\nshort\n")
    jobs.ingest(lake, str(folder), FIRST)
    jobs.ingest(lake, str(folder), FIRST, file_format="csv")
    found = {(r.source_id.split("-")[0], r.reason, r.corrupt_record) for r in jobs.rejected_records(lake).collect()}
    assert found == {
        ("b", "document does not parse", json.dumps(TYPE_2)[:60]),
        ("c", "line does not fit the header", "Hip, with comma,9,3"), ("c", "line does not fit the header", "short")}
    assert jobs.bronze_charges(lake).count() == 5 and jobs.rejected_documents(lake).isEmpty()
    assert [(r.source_name, r.reason) for r in lake.read(jobs.REJECTED_FILES).collect()] == [("b", "document does not parse")]


def test_rejected_files_are_entered_once_per_form(lake, deliver, tmp_path):
    bad = tmp_path / "in" / "b.json"
    deliver("a.json", [])
    bad.write_text("{")
    for run_ts in (FIRST, SECOND):
        assert jobs.ingest(lake, str(tmp_path / "in"), run_ts) == 0
    assert sorted(r.source_name for r in lake.read(jobs.REJECTED_FILES).collect()) == ["a", "b"]
    bad.write_text("{ ")
    jobs.ingest(lake, str(tmp_path / "in"), SECOND)
    assert sorted(r.source_name for r in lake.read(jobs.REJECTED_FILES).collect()) == ["a", "b", "b"]


def test_stream_accounts_for_every_file(lake, deliver, tmp_path):
    def pick_up():
        start_pickup(lake, str(tmp_path / "in"), str(tmp_path / "checkpoint")).awaitTermination()
        rejected = lake.read_or_empty(jobs.REJECTED_FILES, "source_name string, reason string")
        return {r.source_name for r in lake.read(jobs.REGISTRY).collect()}, sorted((r.source_name, r.reason) for r in rejected.collect())

    deliver("a.json", TYPE_1)
    deliver("empty.json", [])
    broken = tmp_path / "in" / "b.json"
    broken.write_text(json.dumps(TYPE_2)[:50])
    first = [("b", "document does not parse"), ("empty", "no charges")]
    assert pick_up() == ({"a"}, first)
    deliver("other/A.json", TYPE_1)
    assert pick_up() == ({"a"}, [("a", "another file has this name"), *first])
    broken.write_text(json.dumps(TYPE_2))
    taken, rejected = pick_up()
    assert taken == {"a", "b"} and len(rejected) == 3
    assert jobs.bronze_charges(lake).count() == 5
    assert pick_up() == (taken, rejected)


def test_large_files_go_through_splits(lake, deliver):
    paths = [deliver("a.json", [TYPE_1, UNKNOWN]), deliver("b.json", TYPE_2)]
    broken = deliver("c.json", TYPE_1)
    with open(broken, "w") as file:
        file.write(json.dumps(TYPE_1)[:-1])
    assert jobs.ingest(lake, [*paths, broken], FIRST, split_bytes=10) == 2
    assert jobs.bronze_charges(lake).count() == 5
    assert [r.hospital_id for r in jobs.rejected_documents(lake).collect()] == ["3"]
    assert [(r.reason, r.corrupt_record) for r in jobs.rejected_records(lake).collect()] == [("file ends within a document", None)]
    assert [r.source_name for r in lake.read(jobs.REJECTED_FILES).collect()] == ["c"]


def test_redelivered_content_is_put_aside(lake, deliver, tmp_path):
    first = deliver("a.json", TYPE_1)
    assert jobs.ingest(lake, first, FIRST, on_duplicate="reject") == 1
    again = [deliver("b.json", TYPE_1), deliver("c.json", TYPE_2), deliver("d.json", TYPE_2), deliver("e.json", [])]
    assert jobs.ingest(lake, [first, *again], SECOND, on_duplicate="reject") == 1
    rejected = {(r.source_name, r.reason) for r in lake.read(jobs.REJECTED_FILES).collect()}
    assert rejected == {("b", "same content as another file"), ("d", "same content as another file"), ("e", "no charges")}
    assert jobs.bronze_charges(lake).count() == 5
    # What was marked but never accepted does not keep its repaired namesake out.
    broken = tmp_path / "in" / "f.json"
    broken.write_text("{")
    for name in ("f.json", "g.json"):
        (tmp_path / "in" / name).write_text("{")
        assert jobs.ingest(lake, str(tmp_path / "in" / name), SECOND, on_duplicate="reject") == 0
    assert {r.reason for r in lake.read(jobs.REJECTED_FILES).filter("source_name IN ('f', 'g')").collect()} == {"document does not parse"}


def test_jobs_leave_no_scratch_tables(spark, lake, target, deliver, tmp_path):
    def stages():
        path = spark._jvm.org.apache.hadoop.fs.Path(staging.scratch_path(spark, "x")).getParent()
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return {status.getPath().getName() for status in files.listStatus(path)}

    before = stages()
    jobs.run_all(lake, [deliver("a.json", TYPE_1), deliver("b.json", [])], FIRST, target)
    start_pickup(lake, str(tmp_path / "in"), str(tmp_path / "checkpoint")).awaitTermination()
    jobs.keep_unknown_fields(lake, FIRST)
    jobs.compact(lake)
    jobs.refine(lake, FIRST)
    assert stages() == before
    assert target.read("fact_charges").count() == 4
