"""Compares a query with its SQL on the same tables.

``python tests/compare.py [sf_dir] [name ...]`` checks all or the named queries and prints timings.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parents[1]))


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def difference(con: duckdb.DuckDBPyConnection, result, sql: str) -> str | None:
    """What is different, or None. Rows are compared as a bag, floats to nine digits."""
    con.register("result_rows", result.toArrow())
    con.execute(f"CREATE OR REPLACE TEMP TABLE wanted AS {sql}")
    got = {row[0]: row[1] for row in con.execute("DESCRIBE result_rows").fetchall()}
    want = {row[0]: row[1] for row in con.execute("DESCRIBE wanted").fetchall()}
    if sorted(got) != sorted(want):
        return f"columns: only here {sorted(set(got) - set(want))}, only in SQL {sorted(set(want) - set(got))}"
    loose = {name: (got[name], want[name]) for name in got if got[name] != want[name] and want[name] not in ('"NULL"', "INTEGER")}
    if loose:
        return f"types: {loose}"

    def rounded(name: str) -> str:
        return f'round("{name}", 9) AS "{name}"' if want[name] == "DOUBLE" else f'CAST("{name}" AS {got[name]}) AS "{name}"'

    columns = ", ".join(rounded(name) for name in sorted(got))
    counts = [con.execute(f"SELECT count(*) FROM {rows}").fetchall()[0][0] for rows in ("result_rows", "wanted")]
    if counts[0] != counts[1]:
        return f"rows: {counts[0]} here, {counts[1]} in SQL"
    if counts[0] == 0:
        return "no rows"
    for one, other in (("result_rows", "wanted"), ("wanted", "result_rows")):
        extra = con.execute(
            f"SELECT {columns} FROM {one} EXCEPT ALL SELECT {columns} FROM {other}"
        ).fetchall()
        if extra:
            return f"{len(extra)} of {counts[0]} rows only in {one}, such as {dict(zip(sorted(got), extra[0]))}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from chargelake.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    failed = 0
    for name in names:
        started = time.time()
        try:
            found = difference(connection, queries()[name](spark, folder), oracle_sql()[name])
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:700]}"
        failed += found is not None
        print(f"{name}: {'ok' if found is None else found} [{time.time() - started:.1f}s]", flush=True)
    print(f"{failed} of {len(names)} failed; without SQL: {sorted(set(queries()) - set(oracle_sql()))}")
