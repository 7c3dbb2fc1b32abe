"""tradeflow: foreign-trade statistics on Spark.

Raw yearly customs files are normalised to one row per year, month, product,
state and country, kept in a Parquet store partitioned by year, refreshed one
year at a time, and enriched with code lookups in several languages.
"""

__version__ = "0.1.0"
