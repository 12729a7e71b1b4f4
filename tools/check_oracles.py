"""Run registered queries and their SQL twins side by side and report differences.

usage: python tools/check_oracles.py FOLDER [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skytune.oracles import ORACLES  # noqa: E402
from skytune.registry import QUERIES  # noqa: E402
from skytune.session import local_session  # noqa: E402

KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def key(row: tuple) -> tuple:
    return tuple((v is None, "" if v is None else v) for v in row)


def plain(value: object) -> object:
    return value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value


def compare(spark, db, folder: str, name: str) -> str:
    started = time.time()
    df = QUERIES[name](spark, folder)
    names = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*names).collect()]
    took = f"{time.time() - started:.1f}s"
    if name not in ORACLES:
        return f"{name}: rows only, {len(ours)} ({took})"
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"{name}: COLUMNS differ {sorted(set(columns) ^ set(names))}"
    order = [columns.index(n) for n in names]
    types = {d[0]: str(d[1]) for d in result.description}
    bad = {n: (t, types[n]) for n, t in df.dtypes if KINDS.get(t) != types[n]}
    theirs = [tuple(plain(row[i]) for i in order) for row in result.fetchall()]
    if sorted(ours, key=key) != sorted(theirs, key=key):
        only = [r for r in sorted(ours, key=key) if r not in set(theirs)][:2]
        other = [r for r in sorted(theirs, key=key) if r not in set(ours)][:2]
        return f"{name}: ROWS differ {len(ours)}/{len(theirs)}\n {names}\n ours {only}\n sql  {other}"
    return f"{name}: ok, {len(ours)} rows ({took})" + (f" TYPES {bad}" if bad else "")


if __name__ == "__main__":
    folder, *wanted = sys.argv[1:]
    session, connection = local_session(), database(folder)
    for query in wanted or QUERIES:
        try:
            print(compare(session, connection, folder, query), flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"{query}: FAILED {str(error)[:700]}", flush=True)
