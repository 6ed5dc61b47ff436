"""Spark-vs-DuckDB parity check, the same shape as the driver's correctness gate.

Row count, column names (sorted) and an order-insensitive multiset of normalised
rows must agree.  Usable from pytest and as a script:

    python -m tests.parity /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6)
    if isinstance(v, int):
        return v
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [cols[i] for i in order], out


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, key: str, query, sql: str | None, con=None):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"key": key, "spark_rows": len(srows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    t0 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["duck_rows"] = len(drows)
    res["duck_sec"] = round(time.time() - t0, 2)
    sc, sr = _canon(scols, srows)
    dc, dr = _canon(dcols, drows)
    if sc != dc:
        res["status"] = f"COLUMNS differ spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        res["status"] = "ROWCOUNT differs"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["status"] = f"VALUES differ e.g. {diff}"
    else:
        res["status"] = "match"
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from laminar.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(entry.queries())
    spark = build_session(shuffle_partitions=8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls.get(k), con)
        except Exception as e:  # noqa: BLE001 - report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
