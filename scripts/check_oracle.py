"""Run registered queries and compare each with its SQL counterpart in DuckDB.

usage: python scripts/check_oracle.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
import pandas as pd

from usagelake.catalog import ORACLES, QUERIES
from usagelake.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def canon(frame: pd.DataFrame) -> list[str]:
    def cell(v: object) -> str:
        if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)):
            return "NULL"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, float):
            return repr(round(v, 6)) if v != int(v) else str(int(v))
        return str(v)

    frame = frame[sorted(frame.columns)]
    return sorted("|".join(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def main() -> int:
    args = sys.argv[1:]
    folder = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    prefixes = [a for a in args if "/" not in a]
    spark = build_session("oracle-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    bad = 0
    for name, run in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        began = time.time()
        try:
            df = run(spark, folder)
            rows = df.collect()
            got = pd.DataFrame([tuple(r) for r in rows], columns=df.columns, dtype=object)
            took = time.time() - began
            if name not in ORACLES:
                print(f"rows-only {name}: {len(got)} rows {took:.1f}s", flush=True)
                continue
            rel = con.execute(ORACLES[name])
            want = pd.DataFrame(rel.fetchall(), columns=[d[0] for d in rel.description], dtype=object)
            if sorted(got.columns) != sorted(want.columns):
                bad += 1
                print(f"FAIL {name}: columns {sorted(got.columns)} vs {sorted(want.columns)}", flush=True)
                continue
            a, b = canon(got), canon(want)
            if a != b:
                bad += 1
                extra, lack = sorted(set(a) - set(b)), sorted(set(b) - set(a))
                print(f"FAIL {name}: {len(a)} vs {len(b)} rows; only ours {extra[:3]}; only sql {lack[:3]}", flush=True)
            else:
                print(f"ok   {name}: {len(a)} rows {took:.1f}s", flush=True)
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:700]}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
