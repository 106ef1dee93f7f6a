"""Run queries beside their SQL in DuckDB and compare every value."""

from __future__ import annotations

import importlib
import sys
import time
from collections import Counter

import checks

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def sql_rows(folder: str, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]).upper() for d in cursor.description]
    return names, types, cursor.fetchall()


KINDS = {
    "string": "text", "varchar": "text", "str": "text", "double": "float", "float": "float",
    "boolean": "bool", "bool": "bool", "int": "int", "integer": "int", "bigint": "int",
    "smallint": "int", "tinyint": "int",
}


def kind(type_name: str) -> str:
    return KINDS.get(type_name.lower(), type_name.lower())


def difference(df, folder: str, sql: str) -> str | None:
    """A description of the first difference, or None when both results agree."""
    names, types, expected = sql_rows(folder, sql)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    ours = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    theirs = {n: kind(t) for n, t in zip(names, types)}
    if ours != theirs:
        return f"types {ours} against {theirs}"
    at = {n: i for i, n in enumerate(names)}
    left = Counter(tuple(r[n] for n in order) for r in df.collect())
    right = Counter(tuple(r[at[n]] for n in order) for r in expected)
    if left == right:
        return None
    return (f"{sum(left.values())} rows against {sum(right.values())}; only here "
            f"{list((left - right).items())[:3]}; only in SQL {list((right - left).items())[:3]}")


def main(folder: str, modules: list[str], only: set[str]) -> int:
    from tablewright.session import local_session

    spark = local_session(8)
    if modules:
        for m in modules:
            importlib.import_module(f"checks.{m}")
    else:
        checks.load_all()
    bad = 0
    for name, fn in checks.QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            sql = checks.ORACLES.get(name)
            df = fn(spark, folder)
            note = difference(df, folder, sql) if sql else None
            rows = "" if sql else f" rows={df.count()} {df.schema.simpleString()}"
        except Exception as e:  # noqa: BLE001
            note, rows = f"{type(e).__name__}: {str(e)[:1200]}", ""
        bad += note is not None
        print(f"{'ok  ' if note is None else 'FAIL'} {time.time() - start:6.2f}s {name}{rows}", flush=True)
        if note:
            print("     ", note, flush=True)
    print(f"{bad} of {len(checks.QUERIES)} differ")
    return bad


if __name__ == "__main__":
    folder = sys.argv[1]
    names = sys.argv[2:]
    sys.exit(bool(main(folder, [n[1:] for n in names if n.startswith("@")],
                       {n for n in names if not n.startswith("@")})))
