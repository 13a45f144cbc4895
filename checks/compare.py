"""Run queries against their SQL counterparts and report differences.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries
from checks.session import local_session


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        files = f"{file}/*.parquet" if file.is_dir() else file
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{files}')")
    return con


def _by_name(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> list[str]:
    """What differs between a query and its SQL: columns, types, rows."""
    frame = queries()[name](spark, folder)
    answer = con.execute(oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(set(columns) ^ set(frame.columns))}"]
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
    types["boolean"] = "BOOLEAN"
    found = {d[0]: str(d[1]) for d in answer.description}
    problems = [
        f"type of {c}: {t} and {found[c]}" for c, t in frame.dtypes if types.get(t, t) != found[c]
    ]
    ours = _by_name(frame.columns, frame.collect())
    theirs = _by_name(columns, answer.fetchall())
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        problems.append(
            f"rows {ours.total()} and {theirs.total()}; "
            f"{extra.total()} only here such as {next(iter(extra), None)}; "
            f"{lacking.total()} only there such as {next(iter(lacking), None)}"
        )
    return problems


def main(folder: str, names: list[str]) -> int:
    spark, con = local_session(), connect(folder)
    failed = 0
    for name in names or queries():
        start = time.time()
        try:
            problems = differences(spark, con, folder, name)
        except Exception as problem:
            problems = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     ")
    print(f"{failed} of {len(names or queries())} differ")
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
