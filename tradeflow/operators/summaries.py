"""The two documented queries over the store: totals by year and by year and month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradeflow.functions import strict_sums


def total_by(store: DataFrame, *keys: str, measure: str = "fob_value", name: str = "value") -> DataFrame:
    """Strict sum of ``measure`` per key (null if any contributing value is null)."""
    missing = [c for c in (*keys, measure) if c not in store.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}")
    aggs, finals = strict_sums([measure])
    return store.groupBy(*keys).agg(*aggs).select(*keys, finals[measure].alias(name))


def total_by_year(store: DataFrame) -> DataFrame:
    return total_by(store, "year")


def total_by_year_month(store: DataFrame) -> DataFrame:
    return total_by(store, "year", "month")
