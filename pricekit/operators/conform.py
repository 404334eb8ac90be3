"""Conform differently shaped cluster feeds to one schema and union them.

Each feed is described by a :class:`FeedSpec` — which column holds the
brand, how the country is obtained, which countries the feed contributes.
``spec_for`` derives the spec from the feed name and its columns by the
naming rules of the source system. Conforming is a pure projection +
filter (no shuffle); only ``union_feeds(distinct=True)`` shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricekit.functions.text import clean_path
from pricekit.sources.tables import columns_ci

# Fixed values of the source system's feed conventions.
BRANDS = ("HP", "hp")
PRINT_BRAND_COLUMN = "ctx_vendor_first"
DEFAULT_BRAND_COLUMN = "Brand"
NAME_COUNTRY = (("_us_", "US"), ("_uk_", "GB"), ("_fr_", "FR"), ("_france_", "FR"))
MONITOR_EMEA_COUNTRIES = {"United Kingdom": "GB", "France": "FR", "Germany": "DE"}
BPS_EMEA_COUNTRIES = {"united kingdom": "GB", "france": "FR", "germany": "DE"}
NA_COUNTRIES = {"united states": "US"}

CANONICAL = ("SKU", "CLUSTER", "PATH", "cluster_size", "fiscal_quarter", "country_code")


@dataclass(frozen=True)
class FeedSpec:
    """How one feed maps onto the canonical cluster row.

    country: a fixed code, or ``None`` to recode the feed's ``country``
    column through ``country_map``; unmatched values are kept (``"keep"``)
    or become NULL (``"null"``). ``allowed`` limits the countries the feed
    contributes. ``size_type`` optionally casts the size (e.g. rounding to
    ``decimal(10,0)``).
    """

    name: str
    brand_col: str | None = DEFAULT_BRAND_COLUMN
    brands: tuple[str, ...] = BRANDS
    country: str | None = None
    country_map: Mapping[str, str] = field(default_factory=dict)
    unmatched: str = "keep"
    allowed: tuple[str, ...] | None = None
    size_type: str | None = None


def spec_for(name: str, columns: Iterable[str], allowed: Sequence[str] | None = None) -> FeedSpec:
    """Derive a feed's spec from its name and columns (naming rules of the source)."""
    cols = {c.lower() for c in columns}
    brand_col = PRINT_BRAND_COLUMN if "print" in name else DEFAULT_BRAND_COLUMN
    if brand_col.lower() not in cols:
        brand_col = None
    country = next((code for marker, code in NAME_COUNTRY if marker in name), None)
    country_map: Mapping[str, str] = {}
    unmatched = "keep"
    if "country" in cols:
        if "monitor_emea" in name:
            country, country_map = None, MONITOR_EMEA_COUNTRIES
        elif "_na_" in name:
            country, country_map, unmatched = None, NA_COUNTRIES, "null"
        elif "bps_emea" in name:
            country, country_map = None, BPS_EMEA_COUNTRIES
    if country is None and not country_map:
        raise ValueError(f"feed {name!r}: no country from its name or a country column")
    size_type = "decimal(10,0)" if "monitor_us" in name else None
    return FeedSpec(name=name, brand_col=brand_col, country=country, country_map=country_map,
                    unmatched=unmatched, allowed=tuple(allowed) if allowed is not None else None,
                    size_type=size_type)


def _recode(c: Column, mapping: Mapping[str, str], unmatched: str) -> Column:
    expr = None
    for src, dst in mapping.items():
        expr = (F.when(c == src, F.lit(dst)) if expr is None else expr.when(c == src, F.lit(dst)))
    fallback = c if unmatched == "keep" else F.lit(None).cast("string")
    return fallback if expr is None else expr.otherwise(fallback)


def _pick_column(ci: Mapping[str, str], *names: str) -> str:
    for n in names:
        if n.lower() in ci:
            return ci[n.lower()]
    raise ValueError(f"none of the columns {names} present")


def conform_feed(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Feed rows → ``SKU, CLUSTER, PATH, cluster_size, fiscal_quarter, country_code``.

    Brand filter only when the feed has the brand column; PATH canonicalised
    by ``clean_path``; ``asp_mean`` stands in for a missing ``cluster_size``
    and ``year_quarter`` for a missing ``fiscal_quarter``; quarter letters
    upper-cased (``2024q1`` → ``2024Q1``). Column names match case-insensitively.
    """
    ci = columns_ci(df)
    if spec.brand_col is not None and spec.brand_col.lower() in ci:
        df = df.filter(F.col(ci[spec.brand_col.lower()]).isin(*spec.brands))
    size = F.col(_pick_column(ci, "cluster_size", "asp_mean"))
    if spec.size_type:
        size = size.cast(spec.size_type)
    quarter = F.col(_pick_column(ci, "fiscal_quarter", "year_quarter"))
    if spec.country is not None:
        country = F.lit(spec.country)
    else:
        country = _recode(F.col(_pick_column(ci, "country")), spec.country_map, spec.unmatched)
    out = df.select(
        F.col(_pick_column(ci, "SKU")).alias("SKU"),
        F.col(_pick_column(ci, "CLUSTER")).alias("CLUSTER"),
        clean_path(F.col(_pick_column(ci, "PATH"))).alias("PATH"),
        size.cast("double").alias("cluster_size"),
        F.replace(quarter, F.lit("q"), F.lit("Q")).alias("fiscal_quarter"),
        country.alias("country_code"),
    )
    if spec.allowed is not None:
        out = out.filter(F.col("country_code").isin(*spec.allowed))
    return out


def union_feeds(frames: Sequence[DataFrame], distinct: bool = True) -> DataFrame:
    """Union of conformed feeds by name; ``distinct`` gives SQL ``UNION`` semantics."""
    out = reduce(lambda a, b: a.unionByName(b), frames)
    return out.distinct() if distinct else out


def canonical_clusters(df: DataFrame) -> DataFrame:
    """Upper-case SKU, quarter ``YYYYQn`` → ``YYYYQ0n``, keep SKUs of 6 or 7 characters."""
    sku = F.upper("SKU")
    return (df.select(
                sku.alias("SKU"), "CLUSTER", "PATH", "cluster_size",
                F.replace(F.col("fiscal_quarter"), F.lit("Q"), F.lit("Q0")).alias("fiscal_quarter"),
                "country_code")
            .filter(F.length("SKU").isin(6, 7)))


def conform_all(feeds: Mapping[str, DataFrame], allowed: Mapping[str, Sequence[str]] | None = None,
                with_name: bool = False) -> list[DataFrame]:
    """Conform every feed by its derived spec; ``allowed`` maps feed name → countries."""
    out = []
    for name, df in feeds.items():
        spec = spec_for(name, df.columns, (allowed or {}).get(name))
        frame = conform_feed(df, spec)
        out.append(frame.withColumn("feed", F.lit(name)) if with_name else frame)
    return out
