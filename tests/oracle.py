"""Spark-vs-DuckDB comparison used by the tests and by hand.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v if EXACT else round(v, 9))
    if v is None:
        return "NULL"
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def rows_key(rows):
    return sorted(tuple(_norm(x) for x in r) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """Returns (ok, message)."""
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = [SPARK_TO_DUCK.get(t, t) for _, t in sdf.dtypes]
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_types = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall() and
               [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    d_types = [d_types[i] for i in order]
    if s_types != d_types:
        return False, f"types differ: spark={list(zip(s_cols, s_types))} duck={list(zip(s_cols, d_types))}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_key(s_rows), rows_key(d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(1 for x, y in zip(a, b) if x != y)} rows), e.g. {diff}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from plaudit.session import build_session
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:40s} rows-only {n}")
            continue
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{name:40s} {'OK ' if ok else 'BAD'} {msg}")
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
