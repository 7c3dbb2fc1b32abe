"""Keeping the store current: which years to (re)load.

No row is scanned here.  For a frame of ``open_store`` the years are the store's folders (a listing) and a year's
last month comes from the footers of that year's files (Parquet aggregate pushdown); both are read when the
frame is built or run, and no job runs before.  Other frames (filtered, or read in another way) are
asked by partition values and a partial max over ``month``.  Comparisons with one-row results use scalar
subqueries, so no join multiplies rows.  Only the final year list (at most one
row per year since 1997) reaches the driver, in ``update_store``.

Rules (a year plan for both flows):

* desired   = years from ``start_year`` (default: the first stored year of
  either flow; never before 1997) up to the current year, capped at the
  official last year;
* kept      = years stored in both flows, except those from the last stored
  year (the earlier of the two flows' last years) to the official last year,
  which may be incomplete;
* download  = desired minus kept;
* nothing to do when both flows end at the official period and no year other
  than the official last year is missing.
"""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.functions import pad_code, period
from tradeflow.plans.store import create_store, flow_path, open_store, stored_years
from tradeflow.schemas import FIRST_DATA_YEAR, FLOWS, STORE_SCHEMAS
from tradeflow.session import checkpoint_root
from tradeflow.sources.raw import route_of

FEED_SCHEMA = "data struct<year:string, monthNumber:string>"


def store_folder(store: DataFrame) -> str | None:
    """The folder of a plain store handle (``open_store``); None for any other frame."""
    if not any([f.name for f in store.schema] == schema.fieldNames() for schema in STORE_SCHEMAS.values()) or not hasattr(store, "_jdf"):
        return None
    plan = store._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() == "Project":
        plan = plan.child()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return None
    roots = plan.relation().location().rootPaths()
    return roots.apply(0).toString() if roots.size() == 1 else None


def _years(spark: SparkSession, years: list[int]) -> DataFrame:
    return spark.range(0, 10_000).where(F.col("id").isin(list(years))).select(F.col("id").cast("int").alias("year"))


def _known_years(store: DataFrame) -> list[int] | None:
    folder = store_folder(store)
    return stored_years(store.sparkSession, folder) if folder else None


_FOOTERS: dict[str, SparkSession] = {}


def _last_month(store: DataFrame, folder: str, year: int) -> DataFrame:
    """One row, ``month``: the last month of a stored year, from the footers of its files."""
    spark = store.sparkSession
    session = _FOOTERS.get(spark.sparkContext.applicationId)
    if session is None:  # aggregates are pushed into footers by the second version of the Parquet source only
        session = _FOOTERS[spark.sparkContext.applicationId] = spark.newSession()
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    columns = T.StructType([f for f in store.schema.fields if f.name != "year"])  # as the store writes its files
    return session.read.schema(columns).parquet(f"{folder}/year={year}").agg(F.max("month").alias("month"))


def available_years(store: DataFrame) -> DataFrame:
    """Distinct stored years, ascending (folders, or partition values only)."""
    years = _known_years(store)
    if years is None:
        return store.select("year").distinct().orderBy("year")
    return _years(store.sparkSession, years).orderBy("year")


def _period_key(year, month) -> Column:
    """year * 100 + month: orders like (year, month) and keeps the aggregate a hash aggregate."""
    return F.col(year) * 100 + F.col(month) if isinstance(year, str) else year * 100 + month


def _key_period(key: Column) -> Column:
    return period(F.floor(key / 100), key % 100)


def latest_period(store: DataFrame, years: list[int] | None = None) -> DataFrame:
    """One row: the last month of the last year as 'yyyy-mm' (null for an empty store).

    For a plain store handle only footers of the last year's files are read.  Otherwise the last year's
    rows are scanned: the year comes from ``years`` (``stored_years``), or from a scan of partition
    values, and prunes the others.
    """
    folder = store_folder(store)
    if folder:
        years = years or stored_years(store.sparkSession, folder)
        if not years:
            return store.sparkSession.range(1).select(F.lit(None).cast("string").alias("period"))
        last = _last_month(store, folder, max(years)).select(_period_key(F.lit(max(years)), F.col("month")).alias("k"))
    else:
        year = F.lit(max(years)) if years else available_years(store).agg(F.max("year")).scalar()
        last = store.where(F.col("year") == year).agg(F.max(_period_key("year", "month")).alias("k"))
    return last.select(_key_period(F.col("k")).alias("period"))


def official_period(feed: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Parse update-service payloads: ``{"data": {"year": .., "monthNumber": ..}}`` -> 'yyyy-mm'.

    Other columns of ``feed`` are kept.
    """
    if payload_col not in feed.columns:
        raise ValueError(f"The '{payload_col}' column does not exist.")
    data = F.from_json(F.col(payload_col), FEED_SCHEMA)["data"]
    p = F.concat(data["year"], F.lit("-"), pad_code(data["monthNumber"], 2))  # null when a part is missing
    return feed.select(*[c for c in feed.columns if c != payload_col], p.alias("period"))


def is_current(store: DataFrame, official: DataFrame, years: list[int] | None = None) -> DataFrame:
    """For each official period: the local period and whether they are equal."""
    local = latest_period(store, years).scalar()
    return official.select("*", local.alias("local_period"), (F.col("period") == local).alias("is_current"))


_PERIOD_PATTERN = "^[0-9]{4}-(0[1-9]|1[0-2])$"


def _as_period_column(spark: SparkSession, official: str | DataFrame) -> Column:
    """The official period as a column; a missing or malformed period raises (it would
    otherwise make every year look out of date)."""
    if isinstance(official, str):
        if not re.match(_PERIOD_PATTERN, official):
            raise ValueError(f"official period must be 'yyyy-mm', got {official!r}")
        return F.lit(official)
    p = official.agg(F.max("period")).scalar()
    bad = F.raise_error(F.lit("official period missing or not 'yyyy-mm'"))
    return F.when(p.rlike(_PERIOD_PATTERN), p).otherwise(bad.cast("string"))


def year_summary(exports: DataFrame, imports: DataFrame, years: dict[str, list[int]] | None = None) -> DataFrame:
    """(flow, year, last_month), the month for each flow's last year only: no other year's files are scanned.

    ``years`` holds the stored years by flow (``stored_years``); without it they are listed for plain
    store handles, and come from a scan of partition values otherwise.
    """

    def one(store: DataFrame, flow: str) -> DataFrame:
        folder = store_folder(store)
        listed = years[flow] if years is not None else stored_years(spark, folder) if folder else None
        if listed is not None:
            known = _years(spark, listed)
            last = F.lit(max(listed, default=None)).cast("int")
        else:
            known = available_years(store)
            last = known.agg(F.max("year")).scalar()
        if folder and not listed:
            month = F.lit(None).cast("int")
        elif folder:
            month = _last_month(store, folder, max(listed)).scalar()
        else:
            month = store.where(F.col("year") == last).agg(F.max("month")).scalar()
        return known.select(F.lit(flow).alias("flow"), "year", F.when(F.col("year") == last, month).alias("last_month"))

    spark = exports.sparkSession
    return one(exports, "export").unionByName(one(imports, "import"))


def refresh_plan(
    exports: DataFrame,
    imports: DataFrame,
    official: str | DataFrame,
    current_year: int | None = None,
    start_year: int | None = None,
    first_year: int = FIRST_DATA_YEAR,
    years: dict[str, list[int]] | None = None,
) -> DataFrame:
    """Years to load into both flows, with a reason: 'missing' (absent from a flow) or 'refresh'.

    ``official`` is a 'yyyy-mm' string or a frame with a ``period`` column
    (for example from ``official_period``).  Empty when the store is current.

    The plan is made from a per-year summary (at most one row per flow and year).  For plain
    store handles that is a listing and two footer aggregates, nothing else; no job runs when the plan is
    made.  For other frames the summary is a scan, so it is checkpointed to the shared checkpoint folder
    and not repeated by later steps.
    """
    spark = exports.sparkSession
    if current_year is None:
        current_year = datetime.date.today().year
    folders = {"export": store_folder(exports), "import": store_folder(imports)}
    if all(folders.values()):
        listed = years or {flow: stored_years(spark, folder) for flow, folder in folders.items()}
        return _plan_of_folders(exports, imports, listed, _as_period_column(spark, official), int(current_year), start_year, first_year)
    checkpoint_root(spark)
    summary = year_summary(exports, imports, years).checkpoint()

    off = _as_period_column(spark, official)
    off_year = F.substring(off, 1, 4).cast("int")

    def flow(name: str) -> DataFrame:
        return summary.where(F.col("flow") == name)

    e = flow("export").select("year")
    i = flow("import").select("year")
    both = e.intersect(i)

    def per_flow(name: str, c: Column) -> Column:
        return F.when(F.col("flow") == name, c)

    # All parameters in one aggregate over the summary, read as one struct-valued
    # scalar subquery (Spark runs it once however many fields are used).
    params = summary.agg(
        F.struct(
            F.min("year").alias("lo"),  # the earlier first year of the two flows
            F.least(F.max(per_flow("export", F.col("year"))), F.max(per_flow("import", F.col("year")))).alias(
                "last_local"  # the earlier last year of the two flows (D14)
            ),
            _key_period(F.max(per_flow("export", _period_key("year", "last_month")))).alias("exp_last"),
            _key_period(F.max(per_flow("import", _period_key("year", "last_month")))).alias("imp_last"),
        ).alias("p")
    ).scalar()
    lo, last_local = params["lo"], params["last_local"]
    exp_current = params["exp_last"] == off
    imp_current = params["imp_last"] == off

    start = F.greatest(F.lit(start_year).cast("int") if start_year is not None else lo, F.lit(first_year))
    stop = F.least(F.lit(int(current_year)), off_year)
    calendar = spark.range(first_year, int(current_year) + 1).select(F.col("id").cast("int").alias("year"))
    desired = calendar.where(F.col("year").between(start, stop))
    kept = both.where(~F.col("year").between(last_local, off_year))
    download = desired.subtract(kept)

    other = download.agg(F.coalesce(F.bool_or(F.col("year") != off_year), F.lit(False))).scalar()
    needed = ~(F.coalesce(exp_current & imp_current, F.lit(False)) & ~other)

    plan = download.join(both.withColumn("_in_both", F.lit(True)), "year", "left")
    reason = F.when(F.col("_in_both").isNull(), F.lit("missing")).otherwise(F.lit("refresh"))
    return plan.where(needed).select(F.col("year").cast("int").alias("year"), reason.alias("reason"))


def _plan_of_folders(
    exports: DataFrame, imports: DataFrame, years: dict[str, list[int]], off: Column, current_year: int, start_year: int | None, first_year: int
) -> DataFrame:
    """The plan where the stored years are known: a filter over a calendar, with one scalar for either flow's last month."""
    spark = exports.sparkSession
    off_year = F.substring(off, 1, 4).cast("int")
    ends = [max(y) for y in years.values() if y]
    both = sorted(set(years["export"]) & set(years["import"]))
    first = start_year if start_year is not None else min((min(y) for y in years.values() if y), default=None)
    start = max(first, first_year) if first is not None else first_year
    last_local = F.lit(min(ends, default=None)).cast("int")

    def wanted(year: Column) -> Column:
        """Whether the year is to be loaded: desired, and not kept."""
        kept = year.isin(both) & ~F.coalesce(year.between(last_local, off_year), F.lit(False))
        return year.between(F.lit(start), F.least(F.lit(current_year), off_year)) & ~kept

    def ends_there(store: DataFrame, flow: str) -> Column:
        return F.coalesce(latest_period(store, years[flow]).scalar() == off, F.lit(False)) if years[flow] else F.lit(False)

    other = F.lit(False)
    for y in range(first_year, current_year + 1):  # an expression; a scalar may not stand in a lambda
        other = other | F.coalesce(wanted(F.lit(y)) & (off_year != y), F.lit(False))
    needed = other | ~(ends_there(exports, "export") & ends_there(imports, "import"))
    rows = spark.range(first_year, current_year + 1).select(F.col("id").cast("int").alias("year")).where(wanted(F.col("year")) & needed)
    reason = F.when(F.col("year").isin(both), F.lit("refresh")).otherwise(F.lit("missing"))
    return rows.select("year", reason.alias("reason"))


def update_store(
    spark: SparkSession,
    raw_paths,
    base: str,
    official: str | DataFrame,
    current_year: int | None = None,
    start_year: int | None = None,
    first_year: int = FIRST_DATA_YEAR,
    layout: str = "auto",
) -> dict:
    """Load the planned years of both flows from ``raw_paths``; nothing when the store is current.

    A missing or unreadable store raises.  Re-running is harmless: each
    planned year is replaced as a whole.  Planned years without a raw file
    are listed under ``missing_files`` (per flow) and left as they are.
    """
    stored = {flow: stored_years(spark, flow_path(base, flow)) for flow in FLOWS}
    if not all(stored.values()):
        raise RuntimeError(f"the store at {base} cannot be read; create it first (years by flow: {stored})")
    exports = open_store(spark, flow_path(base, "export"), "export")
    imports = open_store(spark, flow_path(base, "import"), "import")
    plan = refresh_plan(exports, imports, official, current_year, start_year, first_year, stored)
    rows = plan.orderBy("year").collect()
    years = [r.year for r in rows]
    if not years:
        return {"status": "current", "years": [], "files": {}}
    files = create_store(spark, raw_paths, base, years=years, layout=layout)
    loaded = {flow: {route_of(f)[1] for f in fs} for flow, fs in files.items()}
    missing = {flow: [y for y in years if y not in loaded.get(flow, set())] for flow in ("export", "import")}
    return {
        "status": "updated",
        "years": years,
        "reasons": {r.year: r.reason for r in rows},
        "files": files,
        "missing_files": {flow: ys for flow, ys in missing.items() if ys},
    }
