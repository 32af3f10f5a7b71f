"""Compare a registered query with its DuckDB twin (row count, columns, row multiset)."""

from __future__ import annotations

import math

import duckdb

from lexgrid.plans.tables import TABLES


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def canonical(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = sorted((tuple(norm(t[i]) for i in order) for t in tuples), key=repr)
    return [cols[i] for i in order], rows


_KINDS = {"int": "integer", "tinyint": "integer", "smallint": "integer", "integer": "integer", "bigint": "integer", "hugeint": "integer",
          "long": "integer", "number": "number", "double": "float", "float": "float", "string": "text", "varchar": "text",
          "str": "text", "bool": "boolean", "boolean": "boolean"}


def _kind(name: str) -> str:
    """Integers of any width, floats, texts and booleans by their family; other types are not told apart."""
    return "float" if name.startswith("decimal") else _KINDS.get(name, "other")


def compare(sdf, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    scols, srows = canonical(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = con.execute(sql)
    dcols, drows = canonical([d[0] for d in cur.description], cur.fetchall())
    if scols != dcols:
        return f"columns {scols} vs {dcols}"
    stypes = sorted((f.name, _kind(f.dataType.simpleString())) for f in sdf.schema.fields)
    dtypes = sorted((d[0], _kind(str(d[1]).lower())) for d in cur.description)
    if stypes != dtypes:
        return f"types {[x for x in stypes if x not in dtypes]} vs {[x for x in dtypes if x not in stypes]}"
    if srows != drows:
        only_s = [r for r in srows if r not in set(drows)][:2]
        only_d = [r for r in drows if r not in set(srows)][:2]
        return f"rows {len(srows)} vs {len(drows)}; spark-only {only_s}; duckdb-only {only_d}"
    return None
