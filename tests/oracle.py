"""Compare queries with their oracle SQL. Also a command: python -m tests.oracle [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if hasattr(v, "is_integer") or type(v).__name__ == "Decimal":
        return float(v)
    if isinstance(v, bool):
        return int(v)
    return v


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x) if not isinstance(x, (int, float)) or x is None else (False, "n", float(x)) for x in t))


_KINDS = {"BIGINT": "int", "INTEGER": "int", "DOUBLE": "float", "VARCHAR": "text", "BOOLEAN": "bool"}
_SPARK = {"bigint": "int", "int": "int", "double": "float", "string": "text", "boolean": "bool"}


def compare(df, con, sql) -> str:
    """Empty text when equal, else what differs; columns must agree in kind as well."""
    want_kinds = {r[0]: _KINDS.get(r[1], r[1]) for r in con.execute("describe " + sql).fetchall()}
    got_kinds = {n: _SPARK.get(t, t) for n, t in df.dtypes}
    if want_kinds != got_kinds:
        return f"kinds {sorted(set(got_kinds.items()) ^ set(want_kinds.items()))}"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = _norm(cur.fetchall(), cols)
    got = _norm([tuple(r) for r in df.collect()], df.columns)
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} vs {sorted(cols)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {sorted(cols)} {bad[0]}" if bad else ""


def main(argv: list[str]) -> int:
    from logvigil.plans.catalog import ORACLE, QUERIES
    from logvigil.session import build_session

    sf = argv[0] if argv else "0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, failed = connect(sf_dir), 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            note = compare(df, con, ORACLE[name]) if name in ORACLE else f"rows only: {df.count()}"
            ok = not note or note.startswith("rows only")
        except Exception as ex:  # report and go on
            note, ok = f"{type(ex).__name__}: {str(ex)[:1500]}", False
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t0:.1f}s {note}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
