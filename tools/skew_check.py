"""Skew check of the load: one grain key holds a third of all raw rows.

Runs ``create_store`` (imports) on raw files derived from the driver's tables,
with the event log written to a new scratch folder, then reports per stage:
tasks, records read, shuffle records written and read, and the spread of task
times.  With map-side (partial) aggregation the hot key leaves each map task as
one row, so the reduce side stays balanced.

Usage: python tools/skew_check.py [sf_dir]   (prints a small table)
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(sf_dir: str) -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    logs = tempfile.mkdtemp(prefix="eventlog-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logs)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tradeflow.fixtures import Fixtures
    from tradeflow.plans.store import create_store, flow_path, open_store
    from tradeflow.session import scratch_dir
    from tradeflow.sources.raw import write_raw_files

    fx = Fixtures(spark, sf_dir)
    raw = fx.raw_files("import", coarse=False)
    hot = F.abs(F.hash("CO_NCM", "CO_MES", "VL_FOB")) % 3 == 0
    skewed = raw.select(
        F.when(hot, F.lit(1998)).otherwise(F.col("CO_ANO")).alias("CO_ANO"),
        F.when(hot, F.lit(6)).otherwise(F.col("CO_MES")).alias("CO_MES"),
        F.when(hot, F.lit("1")).otherwise(F.col("CO_NCM")).alias("CO_NCM"),
        F.when(hot, F.lit("SP")).otherwise(F.col("SG_UF_NCM")).alias("SG_UF_NCM"),
        F.when(hot, F.lit(20)).otherwise(F.col("CO_PAIS")).alias("CO_PAIS"),
        "KG_LIQUIDO", "QT_ESTAT", "VL_FOB", "VL_FRETE", "VL_SEGURO",
    )
    landing = scratch_dir(spark, "skew-landing")
    write_raw_files(skewed, landing, "import")
    n_raw = skewed.count()
    n_hot = skewed.where(
        (F.col("CO_ANO") == 1998) & (F.col("CO_MES") == 6) & (F.col("CO_NCM") == "1")
        & (F.col("SG_UF_NCM") == "SP") & (F.col("CO_PAIS") == 20)
    ).count()
    spark.sparkContext.setJobGroup("load", "create_store on skewed raw files")
    base = scratch_dir(spark, "skew-store")
    create_store(spark, landing, base, flows=("import",))
    n_out = open_store(spark, flow_path(base, "import"), "import").count()
    spark.stop()

    stages: dict[int, dict] = {}
    group_jobs: set[int] = set()
    stage_job: dict[int, int] = {}
    for path in sorted(glob.glob(f"{logs}/**/*", recursive=True)):
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == "load":
                        group_jobs.add(ev["Job ID"])
                        for sid in ev.get("Stage IDs", []):
                            stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    s = stages.setdefault(ev["Stage ID"], {"times": [], "in": 0, "sw": 0, "sr": 0, "out": 0})
                    s["times"].append(m.get("Executor Run Time", 0))
                    s["in"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    s["sw"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
                    s["sr"] += (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    s["out"] += (m.get("Output Metrics") or {}).get("Records Written", 0)
    print(f"raw rows {n_raw}, rows on the hot key {n_hot} ({n_hot / n_raw:.0%}), store rows {n_out}")
    print("stage tasks records_in shuffle_write shuffle_read records_out task_ms_median task_ms_max")
    for sid in sorted(s for s in stages if stage_job.get(s) in group_jobs):
        s = stages[sid]
        t = s["times"]
        print(sid, len(t), s["in"], s["sw"], s["sr"], s["out"], int(statistics.median(t)), max(t))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
