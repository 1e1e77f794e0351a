"""Compare a registered query with its SQL on the same parquet files."""

from __future__ import annotations

import glob
import os

import duckdb

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def database(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL's; empty if nothing does."""
    found = con.execute(sql)
    expected = {d[0]: str(d[1]) for d in found.description}
    want = [dict(zip(expected, row)) for row in found.fetchall()]
    kinds = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    problems = []
    if sorted(kinds) != sorted(expected):
        return [f"columns {sorted(kinds)} != {sorted(expected)}"]
    names = sorted(kinds)
    for n in names:
        if kinds[n] != expected[n]:
            problems.append(f"type of {n}: {kinds[n]} != {expected[n]}")
    got = _sorted([tuple(row[n] for n in names) for row in df.select(*[f"`{n}`" for n in names]).collect()])
    want = _sorted([tuple(row[n] for n in names) for row in want])
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    if bad:
        problems.append(f"{len(bad)} rows differ in {names}, first: {bad[0][0]} != {bad[0][1]}")
    return problems
