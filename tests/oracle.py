"""Compare Spark queries with their SQL on DuckDB. Also a script: python tests/oracle.py [names]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if value.__class__.__name__ == "Decimal":
        return float(value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, entry, folder: str) -> tuple[str, str]:
    start = time.time()
    df = entry.run(spark, folder)
    mine = rows_of(df.columns, df.collect())
    spent = time.time() - start
    if entry.sql is None:
        return ("rows", f"{len(mine)} rows, {spent:.1f}s")
    start = time.time()
    cur = con.execute(entry.sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    note = f"{len(mine)} rows, spark {spent:.1f}s, duckdb {time.time() - start:.1f}s"
    if sorted(names) != sorted(df.columns):
        return ("COLUMNS", f"{sorted(df.columns)} vs {sorted(names)}")
    if mine != theirs:
        cols = sorted(names)
        bad = [{c: (str(x)[:200], str(y)[:200]) for c, x, y in zip(cols, a, b) if x != y}
               for a, b in zip(mine, theirs) if a != b][:3]
        return ("DIFF", f"{len(mine)} vs {len(theirs)} rows; {bad}"[:1500])
    kinds = {type(a) is type(b) for x, y in zip(mine, theirs) for a, b in zip(x, y)}
    return ("ok" if kinds <= {True} else "ok (types differ)", note)


if __name__ == "__main__":
    from orderlens.plans.catalogue import all_queries
    from orderlens.session import local_session

    folder = "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if not a.startswith("/")]
    folder = next((a for a in sys.argv[1:] if a.startswith("/")), folder)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    registry = all_queries()
    for name in names or registry:
        try:
            verdict, note = compare(spark, con, registry[name], folder)
        except Exception as exc:  # noqa: BLE001
            verdict, note = "ERROR", f"{type(exc).__name__}: {str(exc)[:900]}"
        print(f"{verdict:8s} {name:28s} {note}", flush=True)
