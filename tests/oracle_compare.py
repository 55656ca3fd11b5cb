"""Run a named Spark query and its DuckDB oracle side by side and compare
row count, column names and the multiset of rows (columns sorted by name).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return repr(v)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, qfn, sql, sf_dir):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    cols = rel.columns
    drows = [dict(zip(cols, r)) for r in rel.fetchall()]
    t2 = time.time()
    scols = sorted(sdf.columns)
    dcols = sorted(cols)
    res = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": scols == dcols, "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    if scols == dcols:
        a = sorted(tuple(_norm(r[c]) for c in scols) for r in srows)
        b = sorted(tuple(_norm(r[c]) for c in dcols) for r in drows)
        res["values_match"] = a == b
        if a != b:
            sa, sb = set(a), set(b)
            res["only_spark"] = list(sa - sb)[:3]
            res["only_oracle"] = list(sb - sa)[:3]
    else:
        res["spark_cols"], res["oracle_cols"] = scols, dcols
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from topicforge.session import get_spark
    spark = get_spark("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    for name in (names or list(qs)):
        if name not in sqls:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print({"name": name, "rows_only": n, "spark_s": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            print(compare(spark, con, name, qs[name], sqls[name], sf_dir), flush=True)
        except Exception as e:  # report and go on
            print({"name": name, "error": repr(e)[:600]}, flush=True)


if __name__ == "__main__":
    main()
