"""Compare a Spark result with SQL run on the same tables by DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(repr(_value(r[i])) for i in order) for r in rows)


def oracle(sql: str, sf_dir: str):
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return columns, cursor.fetchall(), [str(d[1]) for d in cursor.description]


def differences(df, sql: str, sf_dir: str) -> list[str]:
    """What differs, as readable lines; empty when the results are the same."""
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    columns, rows, types = oracle(sql, sf_dir)
    want_names, want = _rows(columns, rows)
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    found = [] if len(got) == len(want) else [f"{len(got)} rows != {len(want)} rows"]
    only_got, only_want = set(got) - set(want), set(want) - set(got)
    found += [f"only in Spark: {r}" for r in sorted(only_got)[:3]]
    found += [f"only in SQL: {r}" for r in sorted(only_want)[:3]]
    if not found and got != want:
        found.append("row multiplicities differ")
    same = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    duck = dict(zip(columns, types))
    for name, type_ in df.dtypes:
        if same.get(type_, type_) != duck[name]:
            found.append(f"type of {name}: {type_} != {duck[name]}")
    return found
