"""Side-by-side check of a Spark query and its DuckDB oracle (row count, columns, value multiset)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, name, query, sql, sf_dir, con=None, show=5):
    con = con or duck(sf_dir)
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    s_hash, s_lines = digest(s_cols, s_rows)
    d_hash, d_lines = digest(d_cols, d_rows)
    ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and s_hash == d_hash
    info = {"name": name, "ok": ok, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
            "columns_equal": sorted(s_cols) == sorted(d_cols)}
    if not ok:
        info["spark_cols"], info["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        sa, da = set(s_lines), set(d_lines)
        info["only_spark"] = sorted(sa - da)[:show]
        info["only_oracle"] = sorted(da - sa)[:show]
    return info


def main(names=None, sf_dir="/root/testdata/sf0.01"):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from tallyframe.session import build_session
    spark = build_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or qs:
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print({"name": name, "rows_only": n}, flush=True)
            continue
        try:
            info = compare(spark, name, qs[name], sqls[name], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            info = {"name": name, "ok": False, "error": repr(e)[:600]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv[1:] or None)
