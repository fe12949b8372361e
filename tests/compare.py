"""Runs registered queries against their SQL on the given tables and reports differences."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if hasattr(value, "is_integer") and not isinstance(value, int):
        return round(float(value), 6)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(spark, con, run, sql: str, sf_dir: str) -> str | None:
    got_df = run(spark, sf_dir)
    got_cols, got = _sorted_rows(got_df.columns, [tuple(r) for r in got_df.collect()])
    res = con.execute(sql)
    want_cols, want = _sorted_rows([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; e.g. {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {a}\n  expected {b}"
    if not got:
        return "no rows on either side"
    return None


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from pulsework.plans.catalog import ORACLES, QUERIES
    from pulsework.session import build_session

    sf = sys.argv[1]
    names = [n for n in QUERIES if not sys.argv[2:] or any(p in n for p in sys.argv[2:])]
    spark = build_session(
        master="local[8]",
        settings={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                  "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in names:
        begun = time.time()
        try:
            if name in ORACLES:
                bad = difference(spark, con, QUERIES[name], ORACLES[name], sf)
                state = "same" if bad is None else f"DIFFERENT {bad}"
            else:
                state = f"{QUERIES[name](spark, sf).count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            state = f"FAILED {str(error)[:1500]}"
        print(f"{name}: {state} ({time.time() - begun:.1f}s)", flush=True)
