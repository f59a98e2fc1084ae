"""Time the headline queries; prints one JSON line.

Each query runs twice in one session, from building it to its last row, into
Spark's no-op sink. ``queries`` and ``value`` are the second runs, ``first_runs``
the first ones, which pay for class loading and compilation.

BENCH_SF_DIR   tables to read   (default /root/testdata/sf0.1)
BENCH_CPUS     local cores      (default all)
BENCH_QUERIES  name prefixes    (default the headline list; 'all' for every query)
"""

import json
import os
import tempfile
import time
from pathlib import Path

from rollcall.queries import QUERIES
from rollcall.session import get_session

HEADLINE = (
    "q01_", "q06_", "q11_", "q13_", "q14_", "q18_", "q19_", "q21_", "q22_", "q24_", "q25_",
    "q28_", "q30_", "q30b_", "q32_", "q34_", "q36c_", "q37_", "q39_",
)

# Scans of written files, timed beside the headline queries; not part of ``value``.
FILES = ("q01b_", "q13b_", "q18b_", "q18c_", "q27b_", "q27c_")


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    wanted = tuple(os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","))
    spark = get_session(
        "rollcall-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="rollcall-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {n: q for n, q in QUERIES.items() if wanted == ("all",) or n.startswith(wanted)}
    first, second = ({n: timed(q, spark, sf_dir) for n, q in chosen.items()} for _ in range(2))
    scans = {n: q for n, q in QUERIES.items() if n.startswith(FILES)} if "BENCH_QUERIES" not in os.environ else {}
    files = {n: timed(q, spark, sf_dir) for n, q in scans.items()}
    print(json.dumps({
        "metric": "headline_queries_wall_time",
        "value": round(sum(second.values()), 3),
        "unit": "sec",
        "queries": second,
        "first_runs": first,
        "file_scans": files,
        "first_runs_value": round(sum(first.values()), 3),
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
