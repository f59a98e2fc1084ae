"""Run registered queries next to their check SQL and compare whole results.

``python -m tests.compare [--sf DIR] [name-prefix ...]``
"""

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(float(f"{v:.10g}"))
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a short description of the first difference."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}\n got {got[1][:2]}\n want {want[1][:2]}"
    for g, w in zip(got[1], want[1]):
        if g != w:
            return f"columns {got[0]}\n got  {g}\n want {w}"
    return None


def main(argv):
    from rollcall.queries import CHECKS, QUERIES
    from tests.conftest import make_session

    sf_dir = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf_dir, argv = argv[1], argv[2:]
    spark, con = make_session(), oracle(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        t = time.time()
        try:
            if name in CHECKS:
                diff = compare(spark, con, name, query, CHECKS[name], sf_dir)
            else:
                diff = None if query(spark, sf_dir).count() else "no rows"
        except Exception as e:  # report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - t:.2f}s {diff or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
