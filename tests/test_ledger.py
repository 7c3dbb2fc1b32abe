"""The ledger beside the store: reconciliation, unchanged years, withdrawn years and maintained totals."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tradeflow.fixtures import Fixtures
from tradeflow.operators.normalise import Reconciliation, normalise
from tradeflow.operators.summaries import total_by_year, total_by_year_month
from tradeflow.plans import ledger, store
from tradeflow.plans.store import create_store, flow_path, open_store, remove_years, stored_years, write_store
from tradeflow.sources.raw import write_raw_files

FLOWS = ("export", "import")


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("ledger-landing"))
    for flow in FLOWS:
        write_raw_files(Fixtures(spark, SF0001).raw_files(flow), folder, flow)
    return folder


def digests(spark, base):
    return {(flow, y): ledger.files_digest(spark, base, flow, y) for flow in FLOWS for y in stored_years(spark, flow_path(base, flow))}


def rows_of(spark, base, flow):
    return sorted(map(tuple, open_store(spark, flow_path(base, flow), flow).collect()), key=str)


def leftovers(tmp_dir, base):
    return os.listdir(f"{base}/_staging") if os.path.isdir(f"{base}/_staging") else []


def test_both_sides_of_the_aggregate_are_counted(spark):
    raw = Fixtures(spark, SF0001).raw()
    for flow in FLOWS:
        watch = Reconciliation(flow)
        normalise(raw, flow, watch).write.format("noop").mode("overwrite").save()
        want = raw.agg(F.count("*").alias("rows"), F.sum("fob_value").alias("fob_value"), F.sum("freight").alias("freight")).first()
        assert watch.differences() == {} and watch.raw.get["rows"] == want.rows and watch.stored.get["fob_value"] == want.fob_value
        assert watch.rows_by_year() == {r.year: r["count"] for r in raw.groupBy("year").count().collect()}
    assert watch.stored.get["freight"] == want.freight  # also where a group's strict sum is null


def test_a_difference_raises_before_anything_is_replaced(spark, landing, tmp_dir, monkeypatch):
    base = tmp_dir + "/store"
    create_store(spark, landing, base)
    before, rows = digests(spark, base), rows_of(spark, base, "export")
    path = flow_path(base, "export")
    few = open_store(spark, path, "export").where("year = 1996").limit(3)
    write_store(spark.createDataFrame(few.collect(), few.schema), path, "export")
    short = digests(spark, base)
    monkeypatch.setattr(Reconciliation, "differences", lambda self: {"rows": (2, 1)})
    with pytest.raises(RuntimeError, match="nothing was replaced"):
        create_store(spark, landing, base)
    assert digests(spark, base) == short and leftovers(tmp_dir, base) == []
    monkeypatch.undo()
    create_store(spark, landing, base)  # the year that was written past the ledger is loaded again, the others stay
    after = digests(spark, base)
    assert {k for k in after if after[k] != short[k]} == {("export", 1996)} and rows_of(spark, base, "export") == rows
    assert {k: v for k, v in after.items() if k != ("export", 1996)} == {k: v for k, v in before.items() if k != ("export", 1996)}


def test_rows_counted_twice_by_a_retried_task_are_counted_again(spark, landing, tmp_dir, monkeypatch):
    real, calls = Reconciliation.differences, []

    def once(self):
        calls.append(self.flow)
        return {"rows": (2, 1)} if calls.count(self.flow) == 1 else real(self)

    monkeypatch.setattr(Reconciliation, "differences", once)
    create_store(spark, landing, tmp_dir + "/store")
    assert sorted(calls) == ["export", "export", "import", "import"] and len(digests(spark, tmp_dir + "/store")) == 14


def test_equal_content_rewrites_nothing(spark, landing, tmp_dir):
    base = tmp_dir + "/store"
    create_store(spark, landing, base)
    before = digests(spark, base)
    again = tmp_dir + "/again"
    raw = Fixtures(spark, SF0001).raw_files("export", layout="legacy")
    write_raw_files(raw.repartition(5), again, "export")  # other files, order and columns: the same rows
    create_store(spark, again, base, flows=("export",))
    assert digests(spark, base) == before
    changed = F.when((F.col("CO_ANO") == 1995) & (F.col("CO_NCM") == raw.where("CO_ANO = 1995").first().CO_NCM), F.col("QT_ESTAT") + 1).otherwise(F.col("QT_ESTAT"))
    write_raw_files(raw.withColumn("QT_ESTAT", changed), tmp_dir + "/changed", "export")
    create_store(spark, tmp_dir + "/changed", base, flows=("export",))
    after = digests(spark, base)
    assert {k for k in after if after[k] != before[k]} == {("export", 1995)}


def test_hash_tells_nulls_and_counts_apart(spark):
    def one(rows):
        df = spark.createDataFrame(rows, "year int, month int, ncm string, state string, country_code int, fob_value long, kg long, qty long")
        return ledger.measured(df.repartition(3), "export").first().hash

    a, b = (2000, 1, "1", "SP", 5, 1, None, 7), (2000, 1, "1", "SP", 5, 1, 7, None)
    hashes = [one(r) for r in ([a], [b], [a, a], [a, b], [a, b, b], [(2000, 1, "1", None, 5, 1, None, 7)], [(2000, 1, None, "1", 5, 1, None, 7)])]
    assert len(set(hashes)) == len(hashes) and one([a, b]) == one([b, a])


@pytest.mark.parametrize("flow", FLOWS)
def test_totals_follow_the_store(spark, landing, tmp_dir, flow):
    base = tmp_dir + "/store"

    def check():
        full = open_store(spark, flow_path(base, flow), flow)
        for own, scan in ((ledger.total_by_year, total_by_year), (ledger.total_by_year_month, total_by_year_month)):
            assert sorted(map(tuple, own(spark, base, flow).collect())) == sorted(map(tuple, scan(full).collect()))

    create_store(spark, landing, base)
    check()
    assert "FileScan parquet" not in ledger.total_by_year(spark, base, flow)._jdf.queryExecution().optimizedPlan().toString()
    path = flow_path(base, flow)
    part = spark.createDataFrame(open_store(spark, path, flow).where("year = 1997 and month < 4").collect(), open_store(spark, path, flow).schema)
    write_store(part.withColumn("fob_value", F.when(F.col("month") != 2, F.col("fob_value"))), path, flow)  # past the ledger, with nulls
    check()
    remove_years(spark, base, flow, [1993, 1850])
    check()
    create_store(spark, landing, base)
    check()


def test_removed_years(spark, landing, tmp_dir):
    base = tmp_dir + "/store"
    create_store(spark, landing, base, flows=("export",))
    assert remove_years(spark, base, "export", [1995, 1900]) == [1995]
    assert 1995 not in stored_years(spark, flow_path(base, "export")) and 1995 not in ledger.read(spark, base, "export")
    assert open_store(spark, flow_path(base, "export"), "export").where("year = 1995").count() == 0
    assert ledger.valid(spark, base).count() == 6 and ledger.valid(spark, tmp_dir + "/none").count() == 0


def test_guard_compares_any_file_name(spark, tmp_dir):
    header = "CO_ANO;CO_MES;CO_NCM;SG_UF_NCM;CO_PAIS;KG_LIQUIDO;QT_ESTAT;VL_FOB\n"
    for k, names in enumerate((["EXP_2023.csv", "EXP_2024.csv"], ["EXP_2023.csv", "x EXP-2024.csv"])):
        folder = f"{tmp_dir}/{k}"
        os.makedirs(folder)
        for name, year in zip(names, (2023, 2024)):
            with open(f"{folder}/{name}", "w", encoding="latin-1") as f:
                f.write(header + f"{year};1;1;SP;20;5;1;500\n")
        create_store(spark, folder, f"{folder}/store", flows=("export",))
        assert stored_years(spark, f"{folder}/store/export") == [2023, 2024]
        with open(f"{folder}/{names[1]}", "a", encoding="latin-1") as f:
            f.write("2023;1;1;SP;20;5;1;500\n")
        with pytest.raises(Exception, match="a file may only hold its own year"):
            create_store(spark, folder, f"{folder}/store", flows=("export",))
    assert store.stored_years(spark, f"{tmp_dir}/0/store/export") == [2023, 2024]
