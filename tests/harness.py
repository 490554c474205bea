"""Local stand-in for the driver's result check: run a registered Spark query and its
DuckDB SQL on the same parquet folder, then compare row count, column names and the
order-insensitive multiset of normalized rows.

    python tests/harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import os  # noqa: E402

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        f = Path(sf_dir) / f"{t}.parquet"
        if f.exists():
            con.execute(f"create view {t} as select * from read_parquet('{f}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if os.environ.get("HARNESS_EXACT"):
            return v + 0.0  # bit-exact comparison of the engines' rounded doubles
        return round(v, 6) + 0.0
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat(sep=" ")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat(sep=" ")
    if hasattr(v, "item"):
        return _norm(v.item())
    if v is pd.NaT:
        return None
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].astype(object).itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=repr)


def _spark_kind(dt) -> str:
    n = dt.typeName()
    if n in ("integer", "short", "byte"):
        return "int32"
    if n == "long":
        return "int64"
    if n in ("double", "float", "decimal"):
        return "float"
    if n.startswith("timestamp"):
        return "timestamp"
    return {"string": "string", "boolean": "bool", "date": "date"}.get(n, n)


def _duck_kind(t) -> str:
    n = str(t).upper()
    if n in ("INTEGER", "SMALLINT", "TINYINT"):
        return "int32"
    if n in ("BIGINT", "HUGEINT", "UBIGINT", "UINTEGER"):
        return "int64"
    if n in ("DOUBLE", "FLOAT") or n.startswith("DECIMAL"):
        return "float"
    if n.startswith("TIMESTAMP"):
        return "timestamp"
    return {"VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date"}.get(n, n)


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    import __spark_entry__ as E

    sdf = E.queries()[name](spark, sf_dir)
    left = sdf.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        return True, f"rows={len(left)} (no oracle)"
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    kinds_l = {f.name: _spark_kind(f.dataType) for f in sdf.schema.fields}
    kinds_r = {c: _duck_kind(t) for c, t in zip(rel.columns, rel.types)}
    if kinds_l != kinds_r:
        bad = {c: (kinds_l.get(c), kinds_r.get(c)) for c in set(kinds_l) | set(kinds_r)
               if kinds_l.get(c) != kinds_r.get(c)}
        return False, f"types differ: {bad}"
    right = rel.df()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns differ: {sorted(left.columns)} vs {sorted(right.columns)}"
    if len(left) != len(right):
        return False, f"row count {len(left)} vs {len(right)}"
    lr, rr = rows_of(left), rows_of(right)
    if lr != rr:
        diff = [(a, b) for a, b in zip(lr, rr) if a != b][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"rows={len(left)}"


def main(argv: list[str]) -> int:
    from careflow.session import local_session
    from careflow.plans import catalog

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(catalog.queries())
    spark = local_session(shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
