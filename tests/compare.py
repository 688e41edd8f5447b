"""Compare a Spark result with DuckDB's, cell by cell."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

# DuckDB type names by Spark type name.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows, order) -> list[tuple]:
    def cell(v):
        return 0.0 if isinstance(v, float) and v == 0 else v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and all values agree."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return [f"columns {names} != {sorted(rel.columns)}"]
    types = dict(zip(rel.columns, map(str, rel.types)))
    out = [f"{f.name}: {f.dataType.simpleString()} != {types[f.name]}" for f in df.schema.fields
           if SAME_TYPE.get(f.dataType.simpleString()) != types[f.name]]
    left = canonical(df.collect(), [df.columns.index(n) for n in names])
    right = canonical(rel.fetchall(), [rel.columns.index(n) for n in names])
    if len(left) != len(right):
        return out + [f"{len(left)} rows != {len(right)} rows"]
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    out += [f"{len(bad)} rows differ, first {a} != {b}" for a, b in bad[:1]]
    if bad and all(_close(a, b) for a, b in bad):
        out.append("(all within 1e-9)")
    return out


def _close(a, b) -> bool:
    return all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) if isinstance(x, float) and isinstance(y, float)
               else x == y for x, y in zip(a, b))
