"""Composite reports over the store.

``imports_by_section``: imports of valid states, totalled by year, state and
ISIC section, with country names.  Plan: the state filter reaches the Parquet
scan, the product and ISIC lookups are broadcast (map side, no shuffle of the
trade rows), a single hash aggregate (partial before the exchange) groups by
the report keys, and the country name is joined after the aggregation, when
only one row per group is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradeflow.functions import strict_sums
from tradeflow.operators.enrich import add_country_name, add_isic_description, filter_states


def trade_by_section(
    store: DataFrame, product: DataFrame, isic: DataFrame, country: DataFrame, lang: str = "en"
) -> DataFrame:
    """Valid states' trade by year, state, ISIC section and country (named).

    Measures: fob_value, cif_value (imports only) and kg, as strict sums.
    """
    measures = [m for m in ("fob_value", "cif_value", "kg") if m in store.columns]
    section = add_isic_description(filter_states(store), product, isic, lang=lang, level="section")
    section_col = [c for c in section.columns if c.startswith("isic_section_desc")][0]
    aggs, finals = strict_sums(measures)
    keys = ["year", "state", section_col, "country_code"]
    totals = section.groupBy(*keys).agg(*aggs).select(*keys, *[finals[m].alias(m) for m in measures])
    named = add_country_name(totals, country, lang=lang)
    name_col = [c for c in named.columns if c.startswith("country_name")][0]
    return named.select("year", "state", section_col, name_col, *measures)


def imports_by_section(
    imports: DataFrame, product: DataFrame, isic: DataFrame, country: DataFrame, lang: str = "en"
) -> DataFrame:
    """The flagship report: imports of valid states by year, state and ISIC section, with country names."""
    return trade_by_section(imports, product, isic, country, lang)
