"""Compare a Spark result with a DuckDB result, row order aside."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def _plain(v):
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return round(float(v), 6)
    return v


def check(df, con, sql: str) -> int:
    """Asserts equal columns, row count and values; returns the row count."""
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    assert len(got) == len(want), (len(got), len(want))
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, f"{len(bad)} of {len(got)} rows differ, first: {str(bad[0])[:800]}"
    return len(got)
