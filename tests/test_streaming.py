"""Landing-folder ingest with Structured Streaming."""

from conftest import SF0001
from tradeflow.fixtures import Fixtures
from tradeflow.plans.store import flow_path, open_store
from tradeflow.sources.raw import write_raw_files
from tradeflow.streaming.landing import run_ingest_once, touched_years


def test_touched_years(spark):
    paths = ["s3://b/l/EXP%202024.csv", "/x/IMP_2023_1.csv", "/x/IMP_2023.csv", "/x/readme.csv"]
    got = touched_years(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert got == {"export": [2024], "import": [2023]}


def test_ingest_new_files_then_late_part(spark, tmp_dir):
    fx = Fixtures(spark, SF0001)
    raw = fx.raw_files("import")
    landing, base, ckpt = tmp_dir + "/landing", tmp_dir + "/store", tmp_dir + "/ckpt"
    write_raw_files(raw.where("CO_ANO < 1999"), landing, "import")
    run_ingest_once(spark, landing, base, ckpt)
    store = open_store(spark, flow_path(base, "import"), "import")
    assert sorted(r.year for r in store.select("year").distinct().collect()) == [1995, 1996, 1997, 1998]
    # a new year arrives, and a late second part of 1998 (only 1998 and the new year are reloaded)
    write_raw_files(raw.where("CO_ANO >= 1999"), landing + "/batch2", "import")
    write_raw_files(raw.where("CO_ANO = 1998 AND CO_MES = 12"), landing + "/late", "import")
    run_ingest_once(spark, landing, base, ckpt)
    store = open_store(spark, flow_path(base, "import"), "import")
    # 1998 now counts its December rows twice (two files carry them), as two raw files would
    expected = fx.imports()
    assert store.where("year <> 1998").exceptAll(expected.where("year <> 1998")).count() == 0
    assert expected.where("year <> 1998").exceptAll(store.where("year <> 1998")).count() == 0
    dec = store.where("year = 1998 AND month = 12").agg({"fob_value": "sum"}).first()[0]
    dec_exp = expected.where("year = 1998 AND month = 12").agg({"fob_value": "sum"}).first()[0]
    assert dec == 2 * dec_exp
    # nothing new: a third run changes nothing
    before = store.count()
    run_ingest_once(spark, landing, base, ckpt)
    assert open_store(spark, flow_path(base, "import"), "import").count() == before


def test_one_file_per_batch_reloads_whole_years(spark, tmp_dir):
    from tradeflow.streaming.landing import start_ingest

    fx = Fixtures(spark, SF0001)
    raw = fx.raw_files("import").where("CO_ANO IN (1996, 1997)")
    landing, base, ckpt = tmp_dir + "/landing", tmp_dir + "/store", tmp_dir + "/ckpt"
    # each year in two parts, in two folders: four files, four micro-batches
    write_raw_files(raw.where("CO_MES <= 6"), landing + "/a", "import")
    write_raw_files(raw.where("CO_MES > 6"), landing + "/b", "import")
    q = start_ingest(spark, landing, base, ckpt, max_files=1)
    q.awaitTermination()
    assert q.exception() is None
    assert len(q.recentProgress) >= 4
    store = open_store(spark, flow_path(base, "import"), "import")
    expected = fx.imports().where("year IN (1996, 1997)")
    assert store.exceptAll(expected).count() == 0 and expected.exceptAll(store).count() == 0


def test_republished_and_old_dated_files_are_loaded(spark, tmp_dir):
    import os
    import time

    header = "CO_ANO;CO_MES;CO_NCM;SG_UF_NCM;CO_PAIS;QT_ESTAT;KG_LIQUIDO;VL_FOB\n"
    landing, base, ckpt = tmp_dir + "/landing", tmp_dir + "/store", tmp_dir + "/ckpt"
    os.makedirs(landing)

    def publish(year, months, age_days=0):
        path = f"{landing}/EXP_{year}.csv"
        with open(path, "w") as f:
            f.write(header + "".join(f"{year};{m};1;SP;20;5;1;500\n" for m in months))
        then = time.time() - 86400 * age_days
        os.utime(path, (then, then))

    def months():
        rows = open_store(spark, flow_path(base, "export"), "export").select("year", "month").collect()
        return sorted((r.year, r.month) for r in rows)

    publish(2018, [1], age_days=30)
    publish(2021, [1])
    assert run_ingest_once(spark, landing, base, ckpt) == {"export": [2018, 2021]}
    assert run_ingest_once(spark, landing, base, ckpt) == {}
    publish(2021, [1, 2])
    publish(2017, [5], age_days=400)
    assert run_ingest_once(spark, landing, base, ckpt) == {"export": [2017, 2021]}
    assert months() == [(2017, 5), (2018, 1), (2021, 1), (2021, 2)]
