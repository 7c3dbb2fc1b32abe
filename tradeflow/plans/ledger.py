"""The ledger: what each stored year holds, one small row for each flow and year beside the store.

A row has the year's raw and stored rows, exact sums of its measures, its last month and a hash of its rows
that does not depend on their order or files: the sums of the halves of two 64-bit hashes of
each row.  It is measured over a load's staged rows and written when their year is published, so equal
hashes mean equal content, and a year's figures are known without reading the store.

A row also has a digest of the names and lengths of the year's files.  A year that anything but a load has
written since has other files: its row does not count (``valid``), and the next load replaces the year.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.schemas import FLOWS, store_schema

MEASURES = ("fob_value", "cif_value", "kg", "qty")
SCHEMA = (
    "flow string, year int, raw_rows long, n_rows long, last_month int, "
    + ", ".join(f"{m} decimal(38,0)" for m in MEASURES)
    + ", months array<struct<month: int, value: decimal(38,0), nulls: bigint>>, hash string, files string"
)
COLUMNS = ("flow", "year", "raw_rows", "n_rows", "last_month", *MEASURES, "months", "hash", "files")


def _hashes(columns: list[str]) -> list[Column]:
    """Sums of the halves of the rows' two hashes (no overflow below 2 ** 31 rows a month); nulls count by a mask, since a hash skips them."""
    nulls = sum((F.col(c).isNull().cast("int") * (1 << k) for k, c in enumerate(columns)), F.lit(0))
    out = []
    for salt in (1, 2):
        h = F.xxhash64(F.lit(salt), nulls, *columns)
        out += [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))]
    return [c.alias(f"_h{k}") for k, c in enumerate(out)]


def measured(store: DataFrame, flow: str) -> DataFrame:
    """The ledger rows of a flow's years, without ``raw_rows``: partial aggregates, by month and then by year."""
    columns = store_schema(flow).fieldNames()
    months = store.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("fob_value").isNull()).alias("nulls"), *_hashes(columns),
        *[(F.sum(m) if m in columns else F.lit(None)).cast("decimal(38,0)").alias(m) for m in MEASURES],
    )
    month = F.struct("month", F.col("fob_value").alias("value"), "nulls")
    parts = [F.sum(F.col(f"_h{k}").cast("decimal(38,0)")).cast("string") for k in range(4)]
    rows = months.groupBy("year").agg(
        F.sum("n_rows").alias("n_rows"), F.max("month").alias("last_month"), *[F.sum(m).cast("decimal(38,0)").alias(m) for m in MEASURES],
        F.sort_array(F.collect_list(month)).alias("months"), F.concat_ws(":", *parts).alias("hash"),
    )
    return rows.select(F.lit(flow).alias("flow"), "year", "n_rows", "last_month", *MEASURES, "months", "hash")


def measure(store: DataFrame, flow: str, raw_rows: dict[int | None, int]) -> dict[int, dict]:
    """Ledger rows by year, at most one for each year since the data begin."""
    return {r.year: r.asDict() | {"raw_rows": raw_rows.get(r.year)} for r in measured(store, flow).collect()}


def _folder(base: str) -> str:
    return f"{base.rstrip('/')}/_ledger"


def _file_system(spark: SparkSession, path: str):
    Path = spark._jvm.org.apache.hadoop.fs.Path
    return Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), Path


def files_digest(spark: SparkSession, base: str, flow: str, year: int) -> str | None:
    """SHA-256 of the names and lengths of a stored year's files; None where there is no such year."""
    fs, Path = _file_system(spark, base)
    folder = Path(f"{base.rstrip('/')}/{flow}/year={year}")
    if not fs.exists(folder):
        return None
    found = sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(folder) if s.getPath().getName()[0] not in "._")
    return hashlib.sha256(repr(found).encode()).hexdigest()


def ledger(spark: SparkSession, base: str) -> DataFrame:
    """All ledger rows of the store at ``base``, valid or not; none where it has no ledger."""
    fs, Path = _file_system(spark, base)
    if not fs.exists(Path(_folder(base))):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("basePath", _folder(base)).json(_folder(base)).select(*COLUMNS)


def read(spark: SparkSession, base: str, flow: str) -> dict[int, dict]:
    """The valid ledger rows of a flow by year."""
    rows = (r.asDict() for r in ledger(spark, base).where(F.col("flow") == flow).collect())
    return {r["year"]: r for r in rows if r["files"] == files_digest(spark, base, flow, r["year"])}


def valid(spark: SparkSession, base: str) -> DataFrame:
    """The valid ledger rows of the store: a load report.  The years' folders are listed; no data file is read."""
    rows = [tuple(r.values()) for flow in FLOWS for _, r in sorted(read(spark, base, flow).items())]
    return spark.createDataFrame(rows, SCHEMA)


def write(spark: SparkSession, base: str, flow: str, rows: dict[int, dict]) -> None:
    """Replace the ledger rows of these years; the others stay.  A row is one small JSON file, put in place by a rename."""
    fs, Path = _file_system(spark, base)
    for y, row in rows.items():
        folder = f"{_folder(base)}/flow={flow}/year={y}"
        kept = {k: v for k, v in row.items() if k not in ("flow", "year")}
        kept["months"] = [m.asDict() for m in row["months"]]
        fs.delete(Path(folder), True)
        out = fs.create(Path(f"{folder}/_row.json"), True)
        try:
            out.write(bytearray(json.dumps(kept, default=int).encode()))
        finally:
            out.close()
        if not fs.rename(Path(f"{folder}/_row.json"), Path(f"{folder}/row.json")):
            raise OSError(f"could not write {folder}/row.json")


def drop(spark: SparkSession, base: str, flow: str, years: list[int]) -> None:
    fs, Path = _file_system(spark, base)
    for y in years:
        fs.delete(Path(f"{_folder(base)}/flow={flow}/year={y}"), True)


def _stored_totals(spark: SparkSession, base: str, flow: str) -> DataFrame:
    """(year, month, value, nulls) from the valid ledger rows, and by a scan of the other years' files only."""
    rows = valid(spark, base).where(F.col("flow") == flow)
    kept = rows.select("year", F.explode("months").alias("m")).select("year", "m.month", "m.value", "m.nulls")
    known = [r.year for r in rows.select("year").collect()]
    store = spark.read.schema(store_schema(flow)).parquet(f"{base.rstrip('/')}/{flow}").where(~F.col("year").isin(known))
    value = F.sum(F.col("fob_value").cast("decimal(38,0)")).cast("decimal(38,0)").alias("value")
    return kept.unionByName(store.groupBy("year", "month").agg(value, F.count_if(F.col("fob_value").isNull()).alias("nulls")))


def _strict(rows: DataFrame, *keys: str) -> DataFrame:
    value = F.when(F.sum("nulls") == 0, F.sum("value").cast("bigint")).alias("value")
    return rows.groupBy(*keys).agg(value)


def total_by_year(spark: SparkSession, base: str, flow: str) -> DataFrame:
    """``summaries.total_by_year`` of a store, from its ledger: no data file of a loaded year is read."""
    return _strict(_stored_totals(spark, base, flow), "year")


def total_by_year_month(spark: SparkSession, base: str, flow: str) -> DataFrame:
    """``summaries.total_by_year_month`` of a store, from its ledger."""
    return _strict(_stored_totals(spark, base, flow), "year", "month")


__all__ = ["FLOWS", "MEASURES", "SCHEMA", "drop", "files_digest", "ledger", "measure", "measured", "read", "total_by_year", "total_by_year_month", "valid", "write"]
