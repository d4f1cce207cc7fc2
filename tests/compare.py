"""Run registered queries and their SQL twins and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
}


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if value is not None and type(value).__name__ == "Decimal":
        return int(value)
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, run, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = run(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    odd = {c: (t, kinds.get(c)) for c, t in df.dtypes if KINDS.get(t) != kinds.get(c)}
    if odd:
        return False, f"types {odd}"
    rel = con.execute(sql)
    want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        odd = [r for r in got[1] if r not in set(want[1])][:2]
        miss = [r for r in want[1] if r not in set(got[1])][:2]
        return False, f"rows {len(got[1])} vs {len(want[1])}; only ours {odd}; only theirs {miss}"
    return True, f"{len(got[1])} rows"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    from clickroll import build_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    session = build_session(
        master="local[8]",
        conf={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
              "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf)
    sqls = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t = time.time()
        try:
            if name in sqls:
                ok, text = compare(session, con, run, sqls[name], sf)
            else:
                ok, text = True, f"{run(session, sf).count()} rows, no twin"
        except Exception as e:  # noqa: BLE001
            ok, text = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t:.1f}s {text}", flush=True)
    print("failed:", bad)
