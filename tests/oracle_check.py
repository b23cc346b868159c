"""Run registered queries against their SQL on the same tables and compare whole results.

    python -m tests.oracle_check <table dir> [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from netforensics.adapters.oracle import SQL
from netforensics.adapters.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if hasattr(value, "quantize"):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) and abs(value) < 1e15 else round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = REGISTRY[name](spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    if mine == theirs:
        return True, f"{len(mine)} rows"
    only_mine = [r for r in mine if r not in set(theirs)][:2] if len(mine) < 200_000 else []
    only_theirs = [r for r in theirs if r not in set(mine)][:2] if len(theirs) < 200_000 else []
    return False, f"{len(mine)} vs {len(theirs)} rows\n   cols {sorted(names)}\n   spark {only_mine}\n   sql   {only_theirs}"


def main() -> int:
    from netforensics.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    failed = []
    for name in wanted or [n for n in REGISTRY if n in SQL]:
        start = time.time()
        try:
            ok, text = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            ok, text = False, f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:24s} {time.time() - start:6.2f}s {text}", flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
