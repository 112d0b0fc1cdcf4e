"""Spark-vs-DuckDB comparison used by the tests and by hand.

Mirrors the driver's check: row count, column names (sorted) and an
order-insensitive hash of the values.

    python tests/oracle_check.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return sorted(columns), len(rows), h, lines


def compare(spark, sf_dir, key, query, sql, con=None, verbose=True):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    sc, sn, sh, sl = digest(sdf.columns, srows)
    dc, dn, dh, dl = digest(dcols, drows)
    ok = (sc == dc) and (sn == dn) and (sh == dh)
    if verbose:
        print(f"{key:28s} {'OK ' if ok else 'BAD'} rows spark={sn} duck={dn} "
              f"cols_equal={sc == dc} spark_sec={t1 - t0:.1f}")
        if not ok:
            if sc != dc:
                print("   spark cols", sc, "\n   duck cols ", dc)
            only_s = sorted(set(sl) - set(dl))[:5]
            only_d = sorted(set(dl) - set(sl))[:5]
            print("   only spark:", only_s)
            print("   only duck: ", only_d)
    return ok


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from pulse.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = []
    for k in (keys or list(qs)):
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            print(f"{k:28s} --  rows={df.count()} (no oracle)")
            continue
        try:
            if not compare(spark, sf_dir, k, qs[k], sqls[k], con):
                bad.append(k)
        except Exception as e:  # report and continue
            print(f"{k:28s} ERR {type(e).__name__}: {str(e)[:300]}")
            bad.append(k)
    print("BAD:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
