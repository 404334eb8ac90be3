"""Latest USD exchange rates, one row per product category of each use case.

A pure map-side plan: filter (pushed to the scan), rule lookup and
``explode`` in one stage; no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricekit.functions.text import to_amount
from pricekit.operators.expand import expand_by_rule
from pricekit.sinks.tables import publish
from pricekit.sources.tables import read_table

# Use cases and the product categories each one prices.
CATEGORY_RULES: dict[str, list[str]] = {
    "pricing - IPG": ["Print"],
    "pricing - PSG": ["Business", "Consumer"],
}
BASE_CURRENCY = "USD"
OUTPUT = ("currency_code", "currency_name", "exchange_rate", "category", "year_month")


def exchange_rates(rates: DataFrame, rules: Mapping[str, Sequence[str]] = CATEGORY_RULES,
                   base: str = BASE_CURRENCY) -> DataFrame:
    latest = rates.filter(F.col("is_latest") & (F.col("from_currency_code") == base))
    expanded = expand_by_rule(latest, "use_case", rules, "category")
    return expanded.select(
        F.col("to_currency_code").alias("currency_code"),
        F.col("to_currency_name").alias("currency_name"),
        to_amount("exchange_rate").alias("exchange_rate"),
        "category", "year_month")


def run(spark: SparkSession, config: Mapping, fmt: str = "parquet", rules=()) -> DataFrame:
    """Rates table has no audit columns and its schema must not change."""
    result = exchange_rates(read_table(spark, config["input"]["rates"]))
    return publish(result, config["output"]["rates"], "rates", rules, fmt=fmt, replace_schema=False)
