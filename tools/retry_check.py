"""Task failures during a store write and a refresh plan: the results stay exact.

Runs on ``local[4,3]`` (up to three attempts per task).  The first attempt of
one task of each job raises; Spark retries it.  Then the store must hold
exactly the expected rows (no duplicates, no leftovers of the failed attempt),
and the refresh plan must equal the plan computed without failures.
Usage: python tools/retry_check.py [sf_dir]; prints one JSON line, exit 1 on a mismatch.
"""

from __future__ import annotations

import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def fail_first_attempt(batches):
    from pyspark import TaskContext

    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        marker = os.path.join(os.environ["RETRY_MARKERS"], f"stage{ctx.stageId()}-failed")
        open(marker, "w").close()  # evidence that the failure happened (local check only)
        raise RuntimeError("injected failure of the first attempt")
    yield from batches


def main(sf_dir: str) -> int:
    import tempfile

    from pyspark.sql import SparkSession

    markers = tempfile.mkdtemp(prefix="retry-markers-", dir="/tmp")
    os.environ["RETRY_MARKERS"] = markers  # inherited by the local Python workers
    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from tradeflow.fixtures import Fixtures
    from tradeflow.plans.refresh import refresh_plan
    from tradeflow.plans.store import flow_path, open_store, write_store
    from tradeflow.session import scratch_dir

    fx = Fixtures(spark, sf_dir)
    expected = fx.imports()
    flaky = expected.mapInPandas(fail_first_attempt, expected.schema)
    base = scratch_dir(spark, "retry")
    path = flow_path(base, "import")
    write_store(flaky, path, "import")
    write_store(fx.exports(), flow_path(base, "export"), "export")
    store = open_store(spark, path, "import")
    missing = expected.exceptAll(store).count()
    extra = store.exceptAll(expected).count()
    leftovers = [f for f in store.inputFiles() if "_temporary" in f or "attempt" in f]

    e = open_store(spark, flow_path(base, "export"), "export")
    flaky_years = e.mapInPandas(fail_first_attempt, e.schema)
    plan = sorted(tuple(r) for r in refresh_plan(flaky_years, store, "2002-03", 2002).collect())
    clean = sorted(tuple(r) for r in refresh_plan(e, store, "2002-03", 2002).collect())
    failures = len(os.listdir(markers))
    ok = missing == 0 and extra == 0 and not leftovers and plan == clean and plan != [] and failures >= 2
    print(json.dumps({"injected_failures": failures, "missing": missing, "extra": extra,
                      "leftovers": len(leftovers), "plan": plan, "ok": ok}))
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"))
