"""Run catalog queries in Spark and their oracle SQL in DuckDB and compare.

Compares column names, a coarse type family per column, row count and the
multiset of rows (columns sorted by name). Usable from pytest and as a
script: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

SPARK_FAMILY = {
    "StringType": "str", "VarcharType": "str", "CharType": "str",
    "IntegerType": "int32", "LongType": "int64", "ShortType": "int16", "ByteType": "int8",
    "FloatType": "float32", "DoubleType": "float64", "BooleanType": "bool",
    "TimestampNTZType": "ts", "TimestampType": "ts_tz", "DateType": "date",
}
DUCK_FAMILY = {
    "VARCHAR": "str", "INTEGER": "int32", "BIGINT": "int64", "SMALLINT": "int16", "TINYINT": "int8",
    "FLOAT": "float32", "DOUBLE": "float64", "BOOLEAN": "bool", "TIMESTAMP": "ts",
    "TIMESTAMP WITH TIME ZONE": "ts_tz", "DATE": "date",
}


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None) -> dict:
    con = con or duck_connect(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_fields = {f.name: SPARK_FAMILY.get(type(f.dataType).__name__, type(f.dataType).__name__)
                for f in sdf.schema.fields}
    s_rows = sdf.collect()
    t1 = time.time()
    rel = con.sql(sql)
    d_fields = {c: DUCK_FAMILY.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_s": round(t1 - t0, 3), "duck_s": round(t2 - t1, 3),
           "rows_spark": len(s_rows), "rows_oracle": len(d_rows)}
    cols = sorted(s_fields)
    out["columns_match"] = cols == sorted(d_fields)
    out["types_match"] = out["columns_match"] and all(s_fields[c] == d_fields[c] for c in cols)
    if not out["types_match"]:
        out["type_diff"] = {c: (s_fields.get(c), d_fields.get(c)) for c in sorted(set(s_fields) | set(d_fields))
                            if s_fields.get(c) != d_fields.get(c)}
    if out["columns_match"]:
        d_cols = list(rel.columns)
        s_multiset = Counter(tuple(_norm(r[c]) for c in cols) for r in s_rows)
        d_multiset = Counter(tuple(_norm(r[d_cols.index(c)]) for c in cols) for r in d_rows)
        out["values_match"] = s_multiset == d_multiset
        if not out["values_match"]:
            only_s = list((s_multiset - d_multiset).elements())[:3]
            only_d = list((d_multiset - s_multiset).elements())[:3]
            out["sample_only_spark"] = [str(x) for x in only_s]
            out["sample_only_oracle"] = [str(x) for x in only_d]
    else:
        out["values_match"] = False
    out["ok"] = out["types_match"] and out["values_match"] and out["rows_spark"] == out["rows_oracle"]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from farelens.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(entry.queries())
    spark = build_session()
    con = duck_connect(sf_dir)
    qs, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, qs[n], sql[n], con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
