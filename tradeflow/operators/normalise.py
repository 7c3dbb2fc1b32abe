"""From raw customs rows to the store grain.

One wide step: a hash aggregate on the five grain keys (partial aggregation on
the map side, final after the exchange; with ``Places`` the raw rows are exchanged by year and
bucket, and the result needs no second exchange to be written by year).  The strict sums share one null
bitmask, so each partial row carries n + 1 aggregate values, not 2n + 1.  Product codes are padded before the
grouping, so '01012100' and '1012100' are one product.
"""

from __future__ import annotations

import warnings
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tradeflow.functions import exact_integer, exact_long, pad_code, strict_sums
from tradeflow.schemas import GRAIN, RAW_RENAMES, store_schema
from tradeflow.sources.names import clean_column_names, rename_known_columns


def warn_without_ansi(df: DataFrame) -> None:
    """Exact sums and casts rely on ANSI mode (the Spark 4 default); say so when it is off."""
    if str(df.sparkSession.conf.get("spark.sql.ansi.enabled", "true")).lower() != "true":
        warnings.warn(
            "spark.sql.ansi.enabled is off: a BIGINT sum overflow wraps around and a malformed number "
            "becomes null instead of raising",
            RuntimeWarning,
            stacklevel=3,
        )


def _to_store_names(raw: DataFrame) -> DataFrame:
    """Accept raw header names (CO_ANO, ...) or store names (year, ...)."""
    return rename_known_columns(clean_column_names(raw), RAW_RENAMES)


def _require(df: DataFrame, cols) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; have {df.columns}")


def _total(column: str) -> Column:
    """Exact sum of the values that are not null, for any number of rows."""
    return F.coalesce(F.sum(F.col(column).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias(column)


class Reconciliation:
    """Rows and exact sums on both sides of the grain aggregate, taken by the job that writes its result.

    ``Observation`` metrics: no row is read twice.  After the job, ``differences`` compares the two sides
    and ``rows_by_year`` tells the raw rows of each year.
    """

    #: Distinct years are few: the sketch is exact for this many.
    YEARS = 1024

    def __init__(self, flow: str):
        self.flow, self.raw, self.stored = flow, Observation(), Observation()

    def before(self, keyed: DataFrame, measures: list[str]) -> DataFrame:
        by_year = F.call_function("approx_top_k", F.col("year"), F.lit(self.YEARS), F.lit(2 * self.YEARS)).alias("by_year")
        return keyed.observe(self.raw, F.count(F.lit(1)).alias("rows"), by_year, *[_total(m) for m in measures])

    def after(self, groups: DataFrame, measures: list[str], rows: str) -> DataFrame:
        total = F.coalesce(F.sum(rows), F.lit(0)).alias("rows")
        return groups.observe(self.stored, F.count(F.lit(1)).alias("groups"), total, *map(_total, measures))

    def differences(self) -> dict[str, tuple]:
        """Metric -> (raw, aggregated) where they differ.

        A map task that is run again after a lost executor may count its rows twice, so a
        difference is to be confirmed by a second ``Reconciliation``.
        """
        raw, stored = self.raw.get, self.stored.get
        return {k: (raw[k], v) for k, v in stored.items() if k in raw and raw[k] != v}

    def rows_by_year(self) -> dict[int | None, int]:
        return {t["item"]: t["count"] for t in self.raw.get["by_year"] or []}


class Places(NamedTuple):
    """Where the grain aggregate puts its rows: each year's keys fall into ``buckets``, and these into ``partitions``.

    A partition then holds whole groups of one year or of few years, so that its task writes them in few files.
    """

    buckets: int
    partitions: int


def _aggregate(raw: DataFrame, measures: list[str], watch: Reconciliation | None = None, places: Places | None = None) -> DataFrame:
    warn_without_ansi(raw)
    df = _to_store_names(raw)
    _require(df, list(GRAIN) + measures)
    types = {f.name: f.dataType for f in df.schema.fields}
    keyed = df.select(
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        pad_code(F.col("ncm").cast("string")).alias("ncm"),
        F.col("state").cast("string").alias("state"),
        F.col("country_code").cast("int").alias("country_code"),
        *[exact_long(F.col(m), m, types[m]).alias(m) for m in measures],
    )
    aggs, finals = strict_sums(measures)
    keys = list(GRAIN)
    if watch is not None:
        keyed, aggs = watch.before(keyed, measures), [*aggs, F.count(F.lit(1)).alias("_rows")]
    if places is not None:  # the bucket follows from the other keys: the groups stay as they are
        bucket = F.pmod(F.xxhash64(*[k for k in GRAIN if k != "year"]), F.lit(places.buckets)).cast("int")
        keyed, keys = keyed.withColumn("_bucket", bucket).repartition(places.partitions, "year", "_bucket"), [*keys, "_bucket"]
    g = keyed.groupBy(*keys).agg(*aggs)
    if watch is not None:
        g = watch.after(g, measures, "_rows")  # the sums are not yet null where a value is missing
    return g.select(*GRAIN, *[finals[m].alias(m) for m in measures])


def normalise_exports(raw: DataFrame, watch: Reconciliation | None = None, places: Places | None = None) -> DataFrame:
    """Raw export rows -> one row per grain key with strict sums of fob_value, kg, qty."""
    g = _aggregate(raw, ["fob_value", "kg", "qty"], watch, places)
    return g.select(*GRAIN, "fob_value", "kg", "qty")


def normalise_imports(raw: DataFrame, watch: Reconciliation | None = None, places: Places | None = None) -> DataFrame:
    """As exports, plus cif_value = fob_value + insurance + freight (null if any part is null)."""
    g = _aggregate(raw, ["fob_value", "insurance", "freight", "kg", "qty"], watch, places)
    cif = F.col("fob_value") + F.col("insurance") + F.col("freight")
    return g.select(*GRAIN, "fob_value", cif.alias("cif_value"), "kg", "qty")


def normalise(raw: DataFrame, flow: str, watch: Reconciliation | None = None, places: Places | None = None) -> DataFrame:
    store_schema(flow)
    return normalise_imports(raw, watch, places) if flow == "import" else normalise_exports(raw, watch, places)


def conform(df: DataFrame, flow: str) -> DataFrame:
    """Enforce the store's column names, order and types.

    Measures go through ``exact_long`` (fractional values raise); narrowing
    integer casts raise on overflow under ANSI mode.  A missing column raises.
    """
    schema = store_schema(flow)
    _require(df, schema.fieldNames())
    warn_without_ansi(df)
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.dataType.simpleString() in ("int", "bigint"):
            cols.append(exact_integer(c, f.dataType.simpleString(), f.name, have[f.name]).alias(f.name))
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
