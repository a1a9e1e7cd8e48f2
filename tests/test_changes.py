"""The commit log and the export that rests on it: late, rebuilt, emptied and interrupted runs."""

from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from chargelake.plans import jobs
from chargelake.sinks.changes import COMMITS, commit_partition, commits, pending_partitions, unfinished_partitions
from chargelake.sinks.export import DIMENSIONS, FACT_PARTITION, FACTS, LEDGER, export_gold, exported
from chargelake.sinks.lakehouse import Lakehouse

EARLY, LATE = datetime(2025, 1, 1, 8), datetime(2025, 1, 2, 8, 0, 0, 250_000)


@pytest.fixture
def lake(spark, tmp_path):
    made = Lakehouse(spark, f"lake_{uuid4().hex[:10]}", str(tmp_path / "lake"))
    for table in DIMENSIONS:
        made.replace(table, spark.range(1))
    return made


class Failing(Lakehouse):
    """Fails when it comes to a table, after it has written a share of the rows."""

    fails_at, share = None, 1.0

    def append(self, table, df, partition_by=()):
        if table == self.fails_at:
            self.fails_at = None
            if table == FACTS:
                super().append(table, df.filter(F.col("n") < self.share), partition_by)
            raise InterruptedError(table)
        super().append(table, df, partition_by)


@pytest.fixture
def target(spark, tmp_path):
    return Failing(spark, f"target_{uuid4().hex[:10]}", str(tmp_path / "target"))


def build(lake, run_ts, count):
    facts = lake.spark.range(count).select(F.col("id").alias("n"), F.lit(run_ts).alias(FACT_PARTITION))
    return commit_partition(lake, FACTS, facts, FACT_PARTITION, F.lit(run_ts))


def sent(target):
    counted = exported(target, target.spark).groupBy(FACT_PARTITION).agg(F.count("n"), F.count_distinct("n"))
    return {row[0]: row[1] for row in counted.collect() if row[1] == row[2]}


def test_late_and_rebuilt_runs_arrive(lake, target):
    assert build(lake, LATE, 10) == 1 and export_gold(lake, target)
    build(lake, EARLY, 5)
    assert export_gold(lake, target) and sent(target) == {LATE: 10, EARLY: 5}
    assert build(lake, LATE, 12) == 3 and export_gold(lake, target)
    assert sent(target) == {LATE: 12, EARLY: 5} and target.read(FACTS).count() == 17
    assert not export_gold(lake, target)


def test_a_run_that_now_yields_nothing_is_taken_back(lake, target):
    build(lake, LATE, 10)
    build(lake, EARLY, 5)
    export_gold(lake, target)
    build(lake, LATE, 0)
    assert lake.read(FACTS).count() == 5
    assert export_gold(lake, target) and sent(target) == {EARLY: 5} and target.read(FACTS).count() == 5


def test_several_runs_go_in_one_export(lake, target):
    for number in range(3):
        build(lake, datetime(2025, 1, 1 + number), 4 + number)
    assert export_gold(lake, target)
    assert sorted(sent(target).values()) == [4, 5, 6] and target.read(LEDGER).count() == 3


@pytest.mark.parametrize("share", [0, 4, 100])
def test_interrupted_between_facts_and_mark(lake, target, share):
    """Nothing, a part, or all of the facts had arrived."""
    build(lake, EARLY, 3)
    export_gold(lake, target)
    build(lake, LATE, 10)
    target.fails_at, target.share = FACTS, share
    with pytest.raises(InterruptedError):
        export_gold(lake, target)
    assert sent(target) == {EARLY: 3}
    assert export_gold(lake, target) and sent(target) == {EARLY: 3, LATE: 10} and target.read(FACTS).count() == 13


def test_interrupted_before_the_mark_sends_no_fact_again(lake, target):
    build(lake, LATE, 10)
    target.fails_at = LEDGER
    with pytest.raises(InterruptedError):
        export_gold(lake, target)
    before = {row.f for row in target.read(FACTS).select(F.input_file_name().alias("f")).distinct().collect()}
    assert export_gold(lake, target) and sent(target) == {LATE: 10}
    assert {row.f for row in target.read(FACTS).select(F.input_file_name().alias("f")).distinct().collect()} == before


def test_readers_see_the_older_batch_until_the_new_one_is_marked(lake, target):
    build(lake, LATE, 10)
    export_gold(lake, target)
    build(lake, LATE, 7)
    target.fails_at = LEDGER
    with pytest.raises(InterruptedError):
        export_gold(lake, target)
    assert target.read(FACTS).count() == 17 and sent(target) == {LATE: 10}
    export_gold(lake, target)
    assert target.read(FACTS).count() == 7 and sent(target) == {LATE: 7}


def test_a_write_that_did_not_end_is_held_back(lake, target):
    build(lake, LATE, 10)
    entry = lake.read(COMMITS).filter("done").limit(1)
    nothing = {name: F.lit(None).cast(entry.schema[name].dataType) for name in ("version", "rows", "checksum")}
    lake.append(COMMITS, entry.withColumns({"run_no": F.col("run_no") + 1, "done": F.lit(False), **nothing}))
    assert unfinished_partitions(lake, FACTS).count() == 1 and not export_gold(lake, target)
    assert build(lake, LATE, 10) == 3 and export_gold(lake, target) and sent(target) == {LATE: 10}


def test_the_same_rows_again_are_not_sent_again(lake, target):
    build(lake, LATE, 10)
    export_gold(lake, target)
    assert build(lake, LATE, 10) == 2 and not export_gold(lake, target)
    build(lake, LATE, 11)
    build(lake, LATE, 10)
    assert export_gold(lake, target) and sent(target) == {LATE: 10}


def test_partitions_without_a_commit_are_offered_once(lake, target):
    old = lake.spark.range(6).select(F.col("id").alias("n"), F.lit(EARLY).alias(FACT_PARTITION))
    lake.overwrite_partitions(FACTS, old, [FACT_PARTITION])
    build(lake, LATE, 2)
    assert export_gold(lake, target) and sent(target) == {EARLY: 6, LATE: 2} and not export_gold(lake, target)


def test_keys_do_not_depend_on_the_session_zone(spark, lake):
    build(lake, LATE, 2)
    keys = commits(lake, FACTS).select("partition", "run_no", "rows").collect()
    assert keys == [(str(int(LATE.timestamp()) * 1_000_000 + 250_000), 1, 2)]
    taken = lake.read(COMMITS).select("partition", "run_no")
    assert pending_partitions(lake, FACTS, FACT_PARTITION, taken).isEmpty()


def test_only_pending_partitions_are_read(lake, target):
    for run_ts, count in ((EARLY, 5), (LATE, 10)):
        build(lake, run_ts, count)
        export_gold(lake, target)
    build(lake, LATE, 11)
    pending = pending_partitions(lake, FACTS, FACT_PARTITION, target.read(LEDGER))
    assert [(row.run_no) for row in pending.collect()] == [3]


def test_jobs_log_their_commits(spark, tmp_path):
    lake = Lakehouse(spark, f"lake_{uuid4().hex[:10]}", str(tmp_path / "lake2"))
    from test_operators import TYPE_1

    import json
    path = tmp_path / "a.json"
    path.write_text(json.dumps(TYPE_1))
    jobs.run_all(lake, str(path), LATE)
    assert [(row.run_no, row.done, row.rows) for row in commits(lake, FACTS).collect()] == [(1, True, 4)]


def test_many_partitions_are_dropped_in_few_statements(spark, lake, monkeypatch):
    rows = spark.range(450).select("id", F.concat(F.lit("p'"), "id").alias("p"))
    lake.replace("t", rows, ["p"])
    statements = []
    run = spark.sql
    monkeypatch.setattr(spark, "sql", lambda text, *more: (statements.append(text), run(text, *more))[1])
    lake.drop_partitions("t", rows.filter("id < 440").select("p"))
    assert len(statements) == 3 and lake.read("t").count() == 10
