"""Spark-vs-DuckDB parity check for registered queries (mirrors the driver's gate).

Run directly for a report:  python -m tests.parity [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", float(v)) if abs(v) < 2**53 else ("i", v)
    if isinstance(v, float):
        return ("n", None) if math.isnan(v) else ("n", v)
    if isinstance(v, decimal.Decimal):
        return ("n", float(v))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("s", str(v))


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


def compare(spark, con, name, fn, sql, sf_dir, show=3):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    if sorted(s_cols) != sorted(d_cols):
        out["error"] = f"columns differ: spark={s_cols} oracle={d_cols}"
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = sorted((tuple(_canon(r[i]) for i in si) for r in s_rows), key=_key)
    b = sorted((tuple(_canon(r[i]) for i in di) for r in d_rows), key=_key)
    out["exact"] = a == b
    if not out["exact"]:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        out["first_diffs"] = [(order, x, y) for x, y in bad[:show]]
    return out


def main(argv):
    from fleetstar.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    ok = 0
    for name in names or list(qs):
        if name not in oracle:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:34s} rows={n} (no oracle)")
            continue
        try:
            r = compare(spark, con, name, qs[name], oracle[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            print(f"{name:34s} FAILED {type(e).__name__}: {str(e)[:400]}")
            continue
        good = r.get("exact") and r["spark_rows"] == r["oracle_rows"]
        ok += bool(good)
        print(f"{name:34s} {'OK ' if good else 'BAD'} spark={r['spark_rows']} oracle={r['oracle_rows']}"
              f" {r.get('error', '')}")
        for d in r.get("first_diffs", []):
            print("    cols:", d[0]); print("    spark:", d[1]); print("    duck: ", d[2])
    print(f"{ok} exact matches")


if __name__ == "__main__":
    main(sys.argv[1:])
