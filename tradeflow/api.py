"""The public surface, under the names a user of the R package knows.

``TradeDB`` binds a store folder and a lookup folder::

    db = TradeDB(spark, "s3://bucket/trade", lookups="s3://bucket/trade-lookups")
    db.create_cs_db("s3://bucket/raw/*.csv", start_year=2015)
    db.update_cs_db("s3://bucket/raw/*.csv", official="2025-06")
    q = db.add_country_name(db.exports.groupBy("year", "country_code").agg(...))

Lookups are loaded once per ``TradeDB`` (so their broadcast size check runs
once); every method returns a lazy DataFrame or, for the two jobs, a summary.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tradeflow.operators import enrich
from tradeflow.operators.summaries import total_by_year, total_by_year_month
from tradeflow.plans.refresh import available_years, latest_period, refresh_plan, update_store
from tradeflow.plans.store import create_store, flow_path, open_store, stored_years
from tradeflow.schemas import FIRST_DATA_YEAR, FLOWS
from tradeflow.sources.lookups import build_lookups, load_lookup

filter_states = enrich.filter_states


class TradeDB:
    def __init__(self, spark: SparkSession, dest_dir: str, lookups: str | None = None):
        self.spark = spark
        self.dest_dir = dest_dir.rstrip("/")
        self.lookup_dir = lookups.rstrip("/") if lookups else f"{self.dest_dir}/lookups"

    # ---------------------------------------------------------------- store
    def open(self, flow: str) -> DataFrame:
        return open_store(self.spark, flow_path(self.dest_dir, flow), flow)

    @property
    def exports(self) -> DataFrame:
        return self.open("export")

    @property
    def imports(self) -> DataFrame:
        return self.open("import")

    def create_cs_db(self, raw_paths, start_year: int | None = None, flows=FLOWS) -> dict:
        """Load the raw files from the first published year (1997) or ``start_year`` on."""
        return create_store(self.spark, raw_paths, self.dest_dir, start_year=start_year, flows=flows, first_year=FIRST_DATA_YEAR)

    def update_cs_db(self, raw_paths, official, start_year: int | None = None, current_year: int | None = None) -> dict:
        return update_store(self.spark, raw_paths, self.dest_dir, official, current_year, start_year)

    def available_years(self, flow: str = "export") -> DataFrame:
        return available_years(self.open(flow))

    def latest_period(self, flow: str = "import") -> DataFrame:
        return latest_period(self.open(flow), stored_years(self.spark, flow_path(self.dest_dir, flow)))

    def refresh_plan(self, official, current_year: int | None = None, start_year: int | None = None) -> DataFrame:
        """The years an update would load, with reasons (empty when the store is current)."""
        years = {flow: stored_years(self.spark, flow_path(self.dest_dir, flow)) for flow in FLOWS}
        return refresh_plan(self.exports, self.imports, official, current_year, start_year, years=years)

    # ---------------------------------------------------------------- lookups
    @cached_property
    def _lookups(self) -> dict[str, DataFrame]:
        return {}

    def build_lookups(self, sources: dict[str, str]) -> dict[str, str]:
        """Build and save lookups from published files: {name: path of the published CSV}."""
        self._lookups.clear()
        return build_lookups(self.spark, sources, self.lookup_dir)

    def lookup(self, name: str) -> DataFrame:
        if name not in self._lookups:
            self._lookups[name] = load_lookup(self.spark, self.lookup_dir, name)
        return self._lookups[name]

    # ---------------------------------------------------------------- enrichment
    def add_country_name(self, x: DataFrame, lang: str = "en", drop_key: bool = True) -> DataFrame:
        return enrich.add_country_name(x, self.lookup("country"), lang, drop_key)

    def add_state_name(self, x: DataFrame, drop_key: bool = True) -> DataFrame:
        return enrich.add_state_name(x, self.lookup("state"), drop_key)

    def add_ncm_description(self, x: DataFrame, lang: str = "en", drop_key: bool = False) -> DataFrame:
        return enrich.add_product_description(x, self.lookup("product"), lang, drop_key)

    def add_units(self, x: DataFrame, lang: str = "en", drop_key: bool = True) -> DataFrame:
        return enrich.add_units(x, self.lookup("product"), self.lookup("unit"), lang, drop_key)

    def add_isic_description(
        self, x: DataFrame, lang: str = "en", level: str = "class", drop_key: bool = True
    ) -> DataFrame:
        return enrich.add_isic_description(x, self.lookup("product"), self.lookup("isic"), lang, level, drop_key)

    @staticmethod
    def filter_states(x: DataFrame) -> DataFrame:
        return enrich.filter_states(x)

    # ---------------------------------------------------------------- documented queries
    def total_exports_by_year(self) -> DataFrame:
        return total_by_year(self.exports)

    def total_imports_by_year_month(self) -> DataFrame:
        return total_by_year_month(self.imports)
