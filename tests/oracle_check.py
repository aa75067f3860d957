"""Run registered queries in Spark and their SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the sorted rows (exact values).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tabprep.session import get_spark  # noqa: E402
from tabprep.sources.tables import TABLES  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


DUCK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
        "BOOLEAN": "boolean", "SMALLINT": "smallint", "TINYINT": "tinyint", "FLOAT": "float",
        "DATE": "date", "HUGEINT": "hugeint"}


def _duck_type(t) -> str:
    s = str(t)
    if s.endswith("[]"):
        return f"array<{_duck_type(s[:-2])}>"
    return DUCK.get(s, s.lower())


def key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    spark = get_spark("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            cols = sdf.columns
            srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows, {dt:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            dcols = rel.columns
            drows = [tuple(norm(x) for x in r) for r in rel.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(dcols):
            print(f"FAIL {name}: columns {cols} vs {dcols}")
            bad += 1
            continue
        order = [dcols.index(c) for c in cols]
        drows = [tuple(r[i] for i in order) for r in drows]
        ok = len(srows) == len(drows) and sorted(srows, key=key) == sorted(drows, key=key)
        st = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        dtypes = {c: _duck_type(t) for c, t in zip(dcols, rel.types)}
        diff_t = [f"{c}: {st[c]} vs {dtypes[c]}" for c in cols if st[c] != dtypes[c]]
        if diff_t:
            print(f"TYPE {name}: " + "; ".join(diff_t))
        if not ok:
            bad += 1
            sa, da = sorted(srows, key=key), sorted(drows, key=key)
            diff = [(a, b) for a, b in zip(sa, da) if a != b][:3]
            print(f"FAIL {name}: rows {len(srows)} vs {len(drows)}; cols {cols}; first diffs {diff}")
        else:
            print(f"OK   {name}: {len(srows)} rows, {dt:.1f}s")
    print(f"done, {bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
