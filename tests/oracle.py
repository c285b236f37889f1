"""Compare named queries with their SQL twins on the same tables.

`python tests/oracle.py [sf dir] [query ...]` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted(rows) -> list[tuple]:
    return sorted((tuple(_plain(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and rows are the same, else what differs first."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} against {sorted(relation.columns)}"
    theirs = {c: str(t) for c, t in zip(relation.columns, relation.types, strict=True)}
    mine = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    if mine != theirs:
        return f"types { {c: (mine[c], theirs[c]) for c in mine if mine[c] != theirs[c]} }"
    quoted = ", ".join(f'"{c}"' for c in names)
    expected = _sorted(con.sql(f"SELECT {quoted} FROM ({sql}) AS q").fetchall())
    actual = _sorted(tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    for a, e in zip(actual, expected, strict=True):
        if a != e:
            return f"{names}: {a} against {e}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from starloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session("oracle", 8)
    con = connect(sf_dir)
    bad = 0
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            sql = oracle_sql().get(name)
            problem = "no oracle" if sql is None else compare(df, con, sql)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {'ok' if problem is None else problem}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
