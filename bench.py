"""

Setup (not timed): raw CSV files for both flows and the lookups are laid out
from the driver's tables, and a store is created from the CSV files.  Timed:
one warm-up run, then the median of five; results are forced with the
``noop`` sink, writes are real writes.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tradeflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(CPUS))))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    spark = session()
    from tradeflow.fixtures import Fixtures
    from tradeflow.operators.enrich import add_isic_description
    from tradeflow.operators.normalise import normalise_imports
    from tradeflow.operators.summaries import total_by_year, total_by_year_month
    from tradeflow.plans.refresh import refresh_plan
    from tradeflow.plans.reports import imports_by_section
    from tradeflow.plans.store import create_store, flow_path, open_store, write_store
    from tradeflow.session import scratch_dir
    from tradeflow.sources.lookups import load_lookup, save_lookup
    from tradeflow.sources.raw import write_raw_files

    work = scratch_dir(spark, "bench")  # below spark.checkpoint.dir
    fx = Fixtures(spark, SF_DIR)

    t0 = time.time()
    landing = f"{work}/landing"
    for flow in ("export", "import"):
        write_raw_files(fx.raw_files(flow, coarse=False, layout="published"), landing, flow)
    lk = f"{work}/lookups"
    save_lookup(fx.product_lookup(), lk, "product")
    save_lookup(fx.isic_lookup(), lk, "isic")
    save_lookup(fx.country_lookup(), lk, "country")
    base = f"{work}/store"
    create_store(spark, landing, base)
    setup_sec = time.time() - t0

    exports = open_store(spark, flow_path(base, "export"), "export")
    imports = open_store(spark, flow_path(base, "import"), "import")
    product, isic, country = (load_lookup(spark, lk, n) for n in ("product", "isic", "country"))
    raw_rows = fx.raw().count()
    one_year = imports.where("year = 1998").cache()
    one_year.count()

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    runs = {"n": 0}

    def create():
        runs["n"] += 1
        create_store(spark, landing, f"{work}/store-run{runs['n']}")

    queries = {
        "normalise_imports": lambda: noop(normalise_imports(fx.raw())),
        "create_store": create,
        "total_by_year": lambda: noop(total_by_year(exports)),
        "total_by_year_month": lambda: noop(total_by_year_month(imports)),
        "add_isic_description_all": lambda: noop(add_isic_description(imports, product, isic, level="all")),
        "store_replace_year": lambda: write_store(one_year, flow_path(base, "import"), "import"),
        "refresh_plan": lambda: noop(refresh_plan(exports, imports, "2002-01", current_year=2002)),
        "flagship_imports_by_section": lambda: noop(imports_by_section(imports, product, isic, country)),
    }
    times = {}
    for name, fn in queries.items():
        fn()  # warm-up
        samples = []
        for _ in range(RUNS):
            t = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t)
        times[name] = round(statistics.median(samples), 3)

    sf = os.path.basename(SF_DIR).replace("sf", "")
    out = {
        "metric": "sum_of_median_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(CPUS),
        "runs": RUNS,
        "rows": {
            "raw_in": raw_rows,
            "import_store": imports.count(),
            "export_store": exports.count(),
        },
        "setup_sec": round(setup_sec, 2),
        "spark": spark.version,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
