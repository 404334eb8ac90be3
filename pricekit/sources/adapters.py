"""Pricing-shaped inputs derived from the driver's TPC-H-like tables.

The library's operators work on pricing feeds (costs, cluster feeds,
exchange rates, ground truth, a geography dimension). The test tables are
``lineitem``, ``orders``, ``part`` ... ; the functions here derive each feed
from them with plain joins and projections, so every registered query reads
the whole given tables and its work grows with them. NULLs, dirty text and
duplicate keys are injected by fixed rules so the edge cases are exercised.

Join strategy is left to Spark's size check (``autoBroadcastJoinThreshold``
at planning, AQE at run time): dimensions under the threshold are
broadcast, anything larger — ``orders`` at scale — is a sort-merge join on
its key. Dimensions are joined to the fact rows one at a time so that the
check sees each dimension's own size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Loader = Callable[..., DataFrame]


def loader(spark: SparkSession, sf_dir: str) -> Loader:
    """``load(name)``: read one table."""
    def load(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return load


def _money_text(c) -> F.Column:
    return c.cast("decimal(12,2)").cast("string")


def _lpad_id(prefix: str, c, width: int) -> F.Column:
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), width, "0"))


# --------------------------------------------------------------------------
# cost feed
# --------------------------------------------------------------------------

def cost_rows(load: Loader) -> DataFrame:
    """The joined columns that the cost feed is made of: one row per lineitem."""
    li = load("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    o = load("orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    p = load("part").select("p_partkey", "p_type")
    s = load("supplier").select("s_suppkey", "s_nationkey")
    n = load("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = load("region").select("r_regionkey", "r_name")
    # each dimension joins the fact rows directly, so Spark's size check sees the
    # dimension's own size (a pre-joined dimension is estimated as a product of sizes)
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(p, F.col("l_partkey") == F.col("p_partkey"))
            .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .drop("o_orderkey", "p_partkey", "s_suppkey", "s_nationkey", "r_regionkey"))


def cost_feed(load: Loader) -> DataFrame:
    """Cost feed: one row per lineitem, columns of the cost source table."""
    return as_cost_feed(cost_rows(load))


def as_cost_feed(rows: DataFrame) -> DataFrame:
    """The columns of the cost source table from :func:`cost_rows`."""
    ln = F.col("l_linenumber")
    return rows.select(
        _lpad_id("P", F.col("l_partkey"), 6).alias("product_id"),
        F.col("l_shipdate").cast("date").alias("start_date"),
        F.col("p_type").alias("prod_line"),
        F.when(F.col("n_nationkey") == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("C"), F.col("n_nationkey").cast("string"))).alias("country_code"),
        F.when(F.col("l_returnflag") == "R", F.lit("NOT COSTED"))
         .when((F.col("l_returnflag") == "A") & (ln == 6), F.lit(None).cast("string"))
         .otherwise(F.lit("COSTED")).alias("cost_status"),
        F.lit("USD").alias("output_currency"),
        F.col("l_linestatus").alias("status"),
        F.when(F.col("l_quantity") == 1, F.lit("0.0"))
         .when(F.col("l_quantity") == 2, F.lit(None).cast("string"))
         .when(F.col("l_quantity") == 3, F.lit("n/a"))
         .otherwise(_money_text(F.col("l_extendedprice"))).alias("matrl_cost"),
        F.when(ln == 3, F.lit(None).cast("string"))
         .otherwise(_money_text(F.col("l_quantity"))).alias("vtrdx_cost"),
        F.when(ln == 1, F.lit(None).cast("string"))
         .otherwise(_money_text(F.col("l_discount") * 100)).alias("malad_cost"),
        F.when(ln == 7, F.lit("n/a"))
         .otherwise(_money_text(F.col("l_tax") * 100)).alias("vwrty_cost"),
        (F.col("l_partkey") % 13).cast("string").alias("vrlty_cost"),
        F.when(F.col("l_orderkey") % 5 == 0, F.lit(""))
         .otherwise((F.col("l_suppkey") % 7).cast("string")).alias("ovblc_cost"),
        F.concat(F.lit("."), (F.col("l_orderkey") % 10).cast("string")).alias("ofxdc_cost"),
        _money_text(F.col("l_extendedprice")).alias("total_cost"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string")).alias("mcc"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("spn"),
        F.when(ln % 2 == 0, F.date_format("o_orderdate", "dd-MMM-yy"))
         .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("latest_timestamp"),
        F.col("o_orderpriority").alias("price_descriptor"),
        F.when(ln % 3 == 0, F.lit("AIR")).otherwise(F.lit("SEA")).alias("mot"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("geo_code"),
        F.lit("COUNTRY").alias("geo_level"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("region"),
        F.col("o_orderdate").alias("inserted_on"),
    )


def cost_text_feed(load: Loader) -> DataFrame:
    """The cost feed as text exports deliver it: ``inserted_on`` and ``start_date`` are text of
    mixed formats, some of it unreadable; some product ids and country names are missing."""
    feed = cost_feed(load)
    line = F.split_part("mcc", F.lit("-"), F.lit(2)).cast("int")
    day = F.col("start_date")
    return feed.withColumns({
        "inserted_on": F.when(line == 5, F.lit("n/a"))
                        .when(line == 6, F.date_format("inserted_on", "dd-MMM-yy"))
                        .when(line == 7, F.date_format("inserted_on", "yyyy-MM-dd'T'HH:mm:ss"))
                        .otherwise(F.date_format("inserted_on", "yyyy-MM-dd HH:mm:ss")),
        "start_date": F.when(line == 1, F.date_format(day, "dd-MMM-yy"))
                       .when(line == 2, F.lit("n/a"))
                       .otherwise(F.date_format(day, "yyyy-MM-dd")),
        "product_id": F.when(line != 4, F.col("product_id")),
        "country_name": F.when(F.col("country_name") != "FRANCE", F.col("country_name")),
    })


# --------------------------------------------------------------------------
# cluster feeds
# --------------------------------------------------------------------------

# The six cluster feed names, in feed-number order 0-5.
CLUSTER_FEEDS = (
    "bps_emea_clustering",
    "monitor_emea_clustering",
    "monitor_us_clustering",
    "bps_na_clustering",
    "print_france_clustering_time_v2",
    "print_uk_clustering_time_v8",
)


def cluster_raw(load: Loader) -> DataFrame:
    """All cluster rows before they are split into differently shaped feeds."""
    li = load("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                 "l_quantity", "l_discount", "l_shipdate")
    p = load("part").select("p_partkey", "p_type")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    period = F.concat(F.year("l_shipdate").cast("string"), F.lit("q"),
                      F.quarter("l_shipdate").cast("string"))
    kind = F.col("l_linenumber") % 4
    return j.select(
        F.when(F.col("l_partkey") % 11 == 0,
               F.concat(F.lit("X"), (F.col("l_partkey") % 1000).cast("string")))
         .when(F.col("l_partkey") % 10 == 0, _lpad_id("p", F.col("l_partkey"), 6))
         .otherwise(_lpad_id("P", F.col("l_partkey"), 5)).alias("sku"),
        (F.col("l_suppkey") % 5).cast("int").alias("cluster"),
        F.when(kind == 0, F.concat(period, F.lit(","), F.lower("p_type")))
         .when(kind == 1, period)
         .when(kind == 2, F.lit(None).cast("string"))
         .otherwise(F.lower("p_type")).alias("path"),
        (F.col("l_quantity") + F.col("l_discount")).alias("size"),
        period.alias("quarter"),
        (F.col("l_suppkey") % 6).cast("int").alias("feed"),
        (F.col("l_orderkey") % 4).cast("int").alias("ctry"),
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("hp"))
         .when(F.col("l_orderkey") % 3 == 1, F.lit("HP"))
         .otherwise(F.lit("other")).alias("brand"),
    )


def _pick(ctry, names: tuple[str, str, str, str]):
    return (F.when(ctry == 0, F.lit(names[0])).when(ctry == 1, F.lit(names[1]))
            .when(ctry == 2, F.lit(names[2])).otherwise(F.lit(names[3])))


def cluster_feeds(load: Loader, raw: DataFrame | None = None) -> dict[str, DataFrame]:
    """The six feeds, each with its own column shape (see the module docs of conform).

    ``raw``: the rows of :func:`cluster_raw` as a written table, so the feeds are scans of it.
    """
    raw = cluster_raw(load) if raw is None else raw
    ctry = F.col("ctry")
    base = [F.col("sku").alias("SKU"), F.col("cluster").alias("CLUSTER"), F.col("path").alias("PATH")]

    def feed(i: int) -> DataFrame:
        return raw.filter(F.col("feed") == i)

    return {
        "bps_emea_clustering": feed(0).select(
            *base, F.col("size").alias("cluster_size"), F.col("quarter").alias("fiscal_quarter"),
            _pick(ctry, ("united kingdom", "france", "germany", "spain")).alias("country"),
            F.col("brand").alias("Brand")),
        "monitor_emea_clustering": feed(1).select(
            *base, F.col("size").alias("asp_mean"), F.col("quarter").alias("fiscal_quarter"),
            _pick(ctry, ("United Kingdom", "France", "Germany", "Spain")).alias("country"),
            F.col("brand").alias("Brand")),
        "monitor_us_clustering": feed(2).select(
            *base, F.col("size").alias("cluster_size"), F.col("quarter").alias("year_quarter"),
            F.col("brand").alias("Brand")),
        "bps_na_clustering": feed(3).select(
            *base, F.col("size").alias("cluster_size"), F.col("quarter").alias("fiscal_quarter"),
            _pick(ctry, ("united states", "united states", "canada", "United States")).alias("country"),
            F.col("brand").alias("brand")),
        "print_france_clustering_time_v2": feed(4).select(
            *base, F.col("size").alias("cluster_size"), F.col("quarter").alias("fiscal_quarter"),
            F.col("brand").alias("ctx_vendor_first")),
        "print_uk_clustering_time_v8": feed(5).select(
            *base, F.col("size").alias("cluster_size"), F.col("quarter").alias("fiscal_quarter")),
    }


# --------------------------------------------------------------------------
# exchange rates, ground truth, product dimension, geography
# --------------------------------------------------------------------------

def exchange_rates(load: Loader) -> DataFrame:
    o = load("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                              "o_orderdate", "o_orderpriority")
    c = load("customer").select("c_custkey", "c_nationkey")
    n = load("nation").select("n_nationkey", "n_name")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    return j.select(
        F.col("n_name").alias("to_currency_name"),
        F.concat(F.lit("CUR"), F.col("n_nationkey").cast("string")).alias("to_currency_code"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("EUR")).otherwise(F.lit("USD")).alias("from_currency_code"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("pricing - IPG"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit("pricing - PSG"))
         .otherwise(F.lit("other")).alias("use_case"),
        (F.col("o_orderstatus") == "F").alias("is_latest"),
        _money_text(F.col("o_totalprice")).alias("exchange_rate"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int").alias("year_month"),
        F.col("o_orderkey"),
    )


def ground_truth(load: Loader) -> DataFrame:
    li = load("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    o = load("orders").select("o_orderkey", "o_custkey")
    c = load("customer").select("c_custkey", "c_nationkey")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey")))
    return j.select(
        _lpad_id("P", F.col("l_partkey"), 5).alias("product_number"),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("country_code"),
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))


def product_dim(load: Loader) -> DataFrame:
    """Product dimension with missing keys (multiples of 7) and duplicates (of 10)."""
    p = load("part").select("p_partkey", "p_type")
    pid = _lpad_id("P", F.col("p_partkey"), 5).alias("product_number")
    main = p.filter(F.col("p_partkey") % 7 != 0).select(pid, F.col("p_type").alias("family"))
    alt = p.filter(F.col("p_partkey") % 10 == 0).select(
        pid, F.concat(F.col("p_type"), F.lit("-ALT")).alias("family"))
    return main.unionByName(alt)


def geography(load: Loader) -> DataFrame:
    n = load("nation")
    r = load("region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"])
