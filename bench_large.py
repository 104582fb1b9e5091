"""Time what depends on the size of a log and of a user, on 12 million rows.

The log is the driver's events, repeated with other ids, so that the rows of every user lie
among those of all others; one user owns a third of it. It is written once below
``BENCH_SCRATCH``, a new temporary folder by default. One JSON line; seconds of one run each.
"""

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from learnlog.operators import history, splits
from learnlog.operators.ordered import SLICE, SliceLimits, split_heavy
from learnlog.session import build_session
from learnlog.sources import fixtures
from learnlog.sources.tables import drop_tables

ROWS = 12_000_000
# No user is cut; the user with a third of the rows is, into slices of a million.
WHOLE = SliceLimits(min_rows=10**15)
CUT = SliceLimits(min_rows=1_000_000, max_users=100, slice_rows=1_000_000)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        f"local[{cpus}]",
        app="bench-large",
        shared=f"{scratch}/shared",
        spark__sql__shuffle__partitions="32",
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = f"{scratch}/log"
    if not os.path.exists(path):
        events = fixtures.interactions(spark, sf_dir)
        copies = -(-ROWS // events.count())
        rows = events.selectExpr("*", f"explode(sequence(0, {copies - 1})) as copy").selectExpr(
            "* except (row_id, user_id, copy)",
            f"row_id * {copies} + copy as row_id",
            f"if(pmod(xxhash64(row_id, copy), 3) = 0, -1, user_id * {copies} + copy) as user_id",
        )
        rows.write.parquet(path)
    log = spark.read.parquet(path)
    results = {"rows": log.count()}

    def timed(name: str, build) -> None:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        results[name] = round(time.perf_counter() - start, 1)

    timed("user_runs, one window per user", lambda: history.user_runs(log, WHOLE))
    timed("user_runs, large user cut", lambda: history.user_runs(log, CUT))
    timed("global_means", lambda: history.global_means(log))
    timed("sample_n of a million", lambda: splits.sample_n(history.answered(log), 10**6, 1))
    timed("repeated_folds of a million", lambda: splits.repeated_folds(history.answered(log), 1, n=10**6))
    sliced = split_heavy(log, CUT)[1]
    sizes = [r["count"] for r in sliced.groupBy("user_id", SLICE).count().orderBy(F.desc("count")).collect()]
    results["slices"] = {"number": len(sizes), "largest": sizes[0], "second smallest": sizes[-2]}
    print(json.dumps(results))
    drop_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()
