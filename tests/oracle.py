"""Run registered queries next to their SQL twins and report differences.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    if hasattr(v, "tolist"):
        return _cell(v.tolist())
    return v


def rows_of(arrow) -> tuple[list[str], Counter]:
    names = sorted(arrow.column_names)
    cols = [arrow.column(n).to_pylist() for n in names]
    return names, Counter(tuple(_cell(v) for v in row) for row in zip(*cols))


def kinds(arrow) -> dict[str, str]:
    same = {"large_string": "string", "timestamp[us, tz=UTC]": "timestamp[us]", "string_view": "string"}
    return {f.name: same.get(str(f.type), str(f.type)) for f in arrow.schema}


def compare(frame, sql: str, con) -> list[str]:
    got, want = frame.toArrow(), con.execute(sql).to_arrow_table()
    notes = []
    (gn, gr), (wn, wr) = rows_of(got), rows_of(want)
    if gn != wn:
        return [f"columns {gn} <> {wn}"]
    gk, wk = kinds(got), kinds(want)
    notes += [f"type of {n}: {gk[n]} <> {wk[n]}" for n in gn if gk[n] != wk[n]]
    if gr != wr:
        extra, lack = gr - wr, wr - gr
        notes.append(f"rows {sum(gr.values())} <> {sum(wr.values())}; only here {len(extra)}, only there {len(lack)}: "
                     f"{list(extra)[:2]} | {list(lack)[:2]}")
    return notes


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from tallyfold.catalog import ORACLES, QUERIES
    from tallyfold.session import get_spark
    spark = get_spark("oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                                "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(args.sf), 0
    names = [n for n in QUERIES if not args.names or any(n == a or n.startswith(a + "*") or (a.endswith("*") and n.startswith(a[:-1])) for a in args.names)]
    for n in names:
        start = time.time()
        try:
            frame = QUERIES[n](spark, args.sf)
            notes = compare(frame, ORACLES[n], con) if n in ORACLES else [f"(no sql) {frame.count()} rows"]
        except Exception as e:  # report and go on
            notes = [f"ERROR {type(e).__name__}: {str(e)[:600]}"]
        fine = not notes or notes[0].startswith("(no sql)")
        bad += not fine
        print(f"{'ok  ' if fine else 'FAIL'} {n:28s} {time.time() - start:6.2f}s {' ; '.join(notes)[:900]}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
