"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else 0.0 if v == 0 else v
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


def _sorted(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, run, sql: str) -> str | None:
    """None if both give the same rows; else what differs."""
    df = run(spark, sf_dir)
    mine, names = df.collect(), df.columns
    got = con.execute(sql)
    theirs_names = [x[0] for x in got.description]
    theirs = got.fetchall()
    if sorted(names) != sorted(theirs_names):
        return f"columns {sorted(names)} and {sorted(theirs_names)}"
    a, b = _sorted(names, mine), _sorted(theirs_names, theirs)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows; {[x for x in a if x not in set(b)][:2]} {[x for x in b if x not in set(a)][:2]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y or [type(v) for v in x] != [type(v) for v in y]]
    return f"{len(bad)} of {len(a)} rows, first {bad[0]}" if bad else None
