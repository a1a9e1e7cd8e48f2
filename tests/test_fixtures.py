"""How the derived input is built: which rows meet first, and how often."""

import pytest

from chargelake import fixtures
from chargelake.plans import queries


@pytest.fixture
def tables(spark, tmp_path):
    """Two customers' orders; one order, one part and one supplier come twice, some keys are unknown or NULL."""
    made = {
        "customer": "SELECT * FROM VALUES (1L), (2L) AS t(c_custkey)",
        "orders": "SELECT *, TIMESTAMP_NTZ'1997-01-02 00:00:00' AS o_orderdate FROM VALUES (1L, 1L), (2L, 2L), (2L, 2L), (3L, 9L), (4L, NULL) AS t(o_orderkey, o_custkey)",
        "supplier": "SELECT *, 'Supplier' AS s_name FROM VALUES (1L), (1L), (2L) AS t(s_suppkey)",
        "part": "SELECT * FROM VALUES (1L), (2L), (2L) AS t(p_partkey)",
        "lineitem": "SELECT o AS l_orderkey, p AS l_partkey, s AS l_suppkey, 1 AS l_linenumber, 2D AS l_quantity, 100D AS l_extendedprice, "
        "0.1D AS l_discount, 0.02D AS l_tax, 'O' AS l_linestatus FROM VALUES (1L, 1L, 2L), (2L, 2L, 1L), (3L, 1L, 1L), (4L, 1L, 1L), (1L, 7L, 1L), (NULL, 1L, 1L) AS t(o, p, s)",
    }
    for name, text in made.items():
        spark.sql(text).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_charges_are_those_of_the_sql(spark, tables):
    scans = {name: fixtures.table(spark, tables, name) for name in fixtures.TABLES}
    want = spark.sql(fixtures.CHARGES_SQL, **scans)
    got = fixtures.charges(spark, tables, order_columns=True)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.count() == 9


def test_lines_do_not_travel_to_customers(spark, tables):
    plan = fixtures.charges(spark, tables)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Join" in line and "c_custkey" in line)
    depth = plan[at].index("Join")
    below = []
    for line in plan[at + 1:]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        below.append(line)
    assert below and not any("l_orderkey" in line for line in below)


@pytest.mark.parametrize("name", ["drop_tables", "catalog_listing", "sink_parquet_roundtrip"])
def test_charges_are_joined_once(spark, tables, monkeypatch, name):
    made, build = [], queries._charges

    def counted(*arguments):
        made.append(1)
        return build(*arguments)

    monkeypatch.setattr(queries, "_charges", counted)
    queries.QUERIES[name](spark, tables).collect()
    assert len(made) == 1
