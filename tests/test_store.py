"""Store writes and reads (D12, D13), and a CSV -> store round trip."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from planutil import plan_text
from tradeflow.fixtures import Fixtures
from tradeflow.operators.normalise import normalise_exports
from tradeflow.plans.store import create_store, flow_path, open_store, write_store
from tradeflow.schemas import EXPORT_SCHEMA
from tradeflow.sources.raw import read_raw, write_raw_files


def test_replace_one_year_keeps_others(spark, tmp_dir):
    fx = Fixtures(spark, SF0001)
    exp = fx.exports()
    path = flow_path(tmp_dir + "/imp-and-exp", "export")  # a base path naming both flows is harmless
    write_store(exp, path, "export")
    before = {r.year: r.n for r in open_store(spark, path, "export").groupBy("year").agg(F.count("*").alias("n")).collect()}
    write_store(exp.where("year = 1996").limit(5), path, "export")
    write_store(exp.limit(0), path, "export")
    after = {r.year: r.n for r in open_store(spark, path, "export").groupBy("year").agg(F.count("*").alias("n")).collect()}
    assert after[1996] == 5
    assert {y: n for y, n in after.items() if y != 1996} == {y: n for y, n in before.items() if y != 1996}


def test_open_store_schema_and_partition_pruning(spark, tmp_dir):
    fx = Fixtures(spark, SF0001)
    path = flow_path(tmp_dir, "export")
    write_store(fx.exports(), path, "export")
    store = open_store(spark, path, "export")
    assert store.schema == EXPORT_SCHEMA
    plan = plan_text(store.where("year = 1997 AND state = 'SP'").select("fob_value"))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan
    assert "ReadSchema: struct<state:string,fob_value:bigint>" in plan


def test_write_plan_rebalances_by_year(spark):
    fx = Fixtures(spark, SF0001)
    from tradeflow.operators.normalise import conform

    out = conform(fx.exports(), "export").hint("rebalance", "year").sortWithinPartitions("year", "month")
    plan = plan_text(out)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_csv_roundtrip_and_split_files(spark, tmp_dir):
    fx = Fixtures(spark, SF0001)
    raw = fx.raw_files("export")
    landing = tmp_dir + "/landing"
    write_raw_files(raw, landing, "export")
    # the same rows split into more files change nothing
    write_raw_files(raw.where("CO_MES <= 6"), landing + "2", "export")
    write_raw_files(raw.where("CO_MES > 6"), landing + "3", "export")
    a = normalise_exports(read_raw(spark, landing, "export"))
    b = normalise_exports(read_raw(spark, [landing + "2", landing + "3"], "export"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    base = tmp_dir + "/store"
    files = create_store(spark, landing, base, flows=("export",))
    assert len(files["export"]) >= 7
    store = open_store(spark, flow_path(base, "export"), "export")
    assert store.exceptAll(fx.exports()).count() == 0 and fx.exports().exceptAll(store).count() == 0
    # sums by year of the store equal sums by year of the raw rows
    s1 = {r.year: r.v for r in store.groupBy("year").agg(F.sum("fob_value").alias("v")).collect()}
    s2 = {r.CO_ANO: r.v for r in raw.groupBy("CO_ANO").agg(F.sum("VL_FOB").alias("v")).collect()}
    assert s1 == s2


def test_compact_and_direct_writes_hold_the_same_rows(spark, tmp_dir):
    fx = Fixtures(spark, SF0001)
    landing = tmp_dir + "/landing"
    write_raw_files(fx.raw_files("import"), landing, "import")
    create_store(spark, landing, tmp_dir + "/a", flows=("import",), compact=True)
    create_store(spark, landing, tmp_dir + "/b", flows=("import",), compact=False)
    a = open_store(spark, flow_path(tmp_dir + "/a", "import"), "import")
    b = open_store(spark, flow_path(tmp_dir + "/b", "import"), "import")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.exceptAll(fx.imports()).count() == 0


def test_stray_year_in_a_file_is_refused(spark, tmp_dir):
    import os

    os.makedirs(tmp_dir + "/raw")
    header = "CO_ANO;CO_MES;CO_NCM;SG_UF_NCM;CO_PAIS;KG_LIQUIDO;QT_ESTAT;VL_FOB\n"
    with open(tmp_dir + "/raw/EXP_2024.csv", "w") as f:
        f.write(header + "2024;1;1;SP;20;1;1;10\n2023;5;1;SP;20;1;1;10\n")
    with pytest.raises(Exception, match="row of year 2023 in file EXP_2024.csv"):
        create_store(spark, tmp_dir + "/raw", tmp_dir + "/db", flows=("export",))


def test_missing_store_is_explained(spark, tmp_dir):
    with pytest.raises(FileNotFoundError, match="no export store"):
        open_store(spark, tmp_dir + "/nothing/export", "export")


def test_load_with_files_split_over_many_tasks(spark, tmp_dir):
    """Large raw files are split over tasks; only the first split has the header."""
    fx = Fixtures(spark, "/root/testdata/sf0.01")
    landing = tmp_dir + "/landing"
    write_raw_files(fx.raw_files("import", layout="published"), landing, "import")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = read_raw(spark, landing, "import")
        assert rows.rdd.getNumPartitions() > 14  # seven files, split into several parts each
        create_store(spark, landing, tmp_dir + "/db", flows=("import",))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    store = open_store(spark, flow_path(tmp_dir + "/db", "import"), "import")
    expected = fx.imports()
    assert store.exceptAll(expected).count() == 0 and expected.exceptAll(store).count() == 0


def test_stored_schema_check(spark, tmp_dir):
    """An older year with a renamed column, another type or conflicting files raises, naming year and column."""
    from tradeflow.plans.store import schema_problems

    rows = Fixtures(spark, SF0001).exports()
    path = flow_path(tmp_dir, "export")
    write_store(rows, path, "export")
    assert schema_problems(spark, path, "export").count() == 0
    assert open_store(spark, path, "export", check=True).count() == rows.count()
    rows.where("year = 1995").drop("year").withColumnRenamed("kg", "peso").write.mode("overwrite").parquet(f"{path}/year=1995")
    with pytest.raises(ValueError, match=r"year=1995: column kg: missing; .*year=1995: column peso: unknown"):
        open_store(spark, path, "export", check=True)
    one = rows.where("year = 1996").drop("year")
    one.limit(5).withColumn("kg", F.col("kg").cast("string")).coalesce(1).write.mode("append").parquet(f"{path}/year=1996")
    found = {tuple(r) for r in schema_problems(spark, path, "export").collect()}
    assert found == {(1995, "kg", "missing"), (1995, "peso", "unknown"), (1996, "*", "files differ")}


def rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("bloom", [None, {"ncm": 1000}])
def test_point_lookups_skip_row_groups(spark, tmp_dir, bloom):
    from tradeflow.plans.store import rows_of_code

    rows = Fixtures(spark, SF0001).exports()
    path = flow_path(tmp_dir, "export")
    write_store(rows, path, "export", bloom=bloom)
    store = open_store(spark, path, "export")
    codes = sorted(r.ncm for r in store.select("ncm").distinct().collect())
    absent = next(c for k in range(10**8) if (c := f"{int(codes[3]) + k:08d}") not in codes)  # inside the range of every row group
    assert codes[0] < absent < codes[-1]
    assert rows_scanned(rows_of_code(store, absent)) == 0 < rows_scanned(rows_of_code(store, codes[5]))
    assert rows_of_code(store, codes[5].lstrip("0")).count() == store.where(F.col("ncm") == codes[5]).count()
    with pytest.raises(ValueError, match="bloom"):
        write_store(rows, path, "export", bloom={"nothing": 5})


def stages_of(spark, run):
    """Stages of the jobs that ``run`` starts."""
    context, group = spark.sparkContext, f"stages-{id(run)}"
    context.setJobGroup(group, "counted")
    try:
        run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    return sum(len(tracker.getJobInfo(job).stageIds) for job in tracker.getJobIdsForGroup(group))


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_raw_files_are_written_without_a_shuffle(spark, tmp_dir, compression):
    """One stage writes them; the session's setting is as before, and a load of them holds all rows."""
    from tradeflow.sources.raw import list_files

    raw = Fixtures(spark, SF0001).table("lineitem").select(
        F.year("l_shipdate").alias("CO_ANO"), F.month("l_shipdate").alias("CO_MES"), F.col("l_partkey").alias("CO_NCM"), F.lit("SP").alias("SG_UF_NCM"),
        F.lit(20).alias("CO_PAIS"), F.col("l_linenumber").alias("KG_LIQUIDO"), F.lit(1).alias("QT_ESTAT"), F.col("l_orderkey").alias("VL_FOB"),
    )
    assert stages_of(spark, lambda: write_raw_files(raw, tmp_dir + "/landing", "export", compression)) == 1
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert all(f.endswith(".csv.gz" if compression else ".csv") for f in list_files(spark, tmp_dir + "/landing"))
    create_store(spark, tmp_dir + "/landing", tmp_dir + "/store", flows=("export",))
    store, expected = open_store(spark, tmp_dir + "/store/export", "export"), normalise_exports(raw)
    assert store.exceptAll(expected).count() == 0 and expected.exceptAll(store).count() == 0


@pytest.mark.parametrize("buckets,partitions", [(1, 1), (3, 5), (40, 7)])
def test_a_load_exchanges_its_rows_once(spark, buckets, partitions):
    """Placed by year and bucket the groups are the same, also with nulls, unpadded codes and repeated keys."""
    from tradeflow.operators.normalise import Places, normalise
    from tradeflow.schemas import GRAIN

    rows = [(1999 + k % 3, 1 + k % 2, c, s, p, k, 2 * k if k % 5 else None, 1) for k in range(60) for c in ("7", "00000007", None) for s, p in (("SP", 1), (None, None))]
    rows += [(None, 1, "7", "SP", 1, 5, 5, 5)] * 3
    raw = spark.createDataFrame(rows, "CO_ANO int, CO_MES int, CO_NCM string, SG_UF_NCM string, CO_PAIS int, KG_LIQUIDO long, QT_ESTAT long, VL_FOB long")
    placed, plain = normalise(raw, "export", places=Places(buckets, partitions)), normalise(raw, "export")
    assert sorted(map(tuple, placed.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    plan = plan_text(placed.sortWithinPartitions(*GRAIN)).split("\n\n\n")[0]
    assert plan.count("Exchange (") == 1 and placed.rdd.getNumPartitions() == partitions


def test_places_follow_the_files_lengths(spark, tmp_dir, monkeypatch):
    import os

    from tradeflow.plans import store

    os.makedirs(tmp_dir + "/raw")
    files = [f"{tmp_dir}/raw/EXP_{n}" for n in ("2001.csv", "2001_1.csv", "2002.csv", "2003.csv.gz")]
    for name, size in zip(files, (600, 200, 100, 25)):
        with open(name, "wb") as f:
            f.write(b"x" * size)
    monkeypatch.setattr(store, "LARGE_TASK", 10)
    monkeypatch.setattr(store, "SMALL_TASK", 10)
    assert store.places(spark, files) == (80, 100)  # 1000 bytes, 800 of them of one year
    monkeypatch.setattr(store, "SMALL_TASK", 10_000)
    assert store.places(spark, files) == (1, 1)
