"""Run queries on both engines and compare: ``python -m checks.compare [dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(round(value, 9))
    return None if value is None else str(value)


def _rows(names, rows):
    at = [names.index(n) for n in sorted(names)]
    return sorted((tuple(_cell(r[i]) for i in at) for r in rows), key=str)


def differences(spark, con, sf_dir: str, name: str) -> str | None:
    """What differs between the engines, or ``None``."""
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None if ours else "no rows"
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    theirs = _rows(names, result.fetchall())
    if ours == theirs:
        return None
    pairs = [(a, b) for a, b in zip(ours, theirs) if a != b][:3]
    return f"{len(ours)} rows against {len(theirs)}; {pairs}"


def main(sf_dir: str = "/root/testdata/sf0.01", *only: str) -> int:
    from hearthline.session import local_session

    spark, con, failed = local_session(), connect(sf_dir), 0
    for name in only or QUERIES:
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.1f}s {name} {found or ''}")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
