"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code, from the same specification, on
the pre-registered views of the driver's tables. Differences of dialect
that matter: Spark's ``yy`` is always 20yy while DuckDB's ``%y`` maps 69-99
to 19yy (hence +100 years below 2000); DuckDB needs explicit NULL ordering.
"""

from __future__ import annotations

from pricekit.plans.cost import COST_COLUMNS
from pricekit.queries import AS_OF, AUDIT_NOW, EARLY_AS_OF, HISTORY_RULES, QC_RULES, WATERMARK

_AS_OF = f"DATE '{AS_OF}'"
_WM = f"TIMESTAMP '{WATERMARK}'"
_NOW = f"TIMESTAMP '{AUDIT_NOW}'"

COST_FEED = """
SELECT 'P' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS product_id,
  CAST(l_shipdate AS DATE) AS start_date,
  p_type AS prod_line,
  CASE WHEN n_nationkey = 7 THEN NULL ELSE 'C' || CAST(n_nationkey AS VARCHAR) END AS country_code,
  CASE WHEN l_returnflag = 'R' THEN 'NOT COSTED'
       WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN NULL ELSE 'COSTED' END AS cost_status,
  'USD' AS output_currency,
  l_linestatus AS status,
  CASE WHEN l_quantity = 1 THEN '0.0' WHEN l_quantity = 2 THEN NULL WHEN l_quantity = 3 THEN 'n/a'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS matrl_cost,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) END AS vtrdx_cost,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(CAST(l_discount * 100 AS DECIMAL(12,2)) AS VARCHAR) END AS malad_cost,
  CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_tax * 100 AS DECIMAL(12,2)) AS VARCHAR) END AS vwrty_cost,
  CAST(l_partkey % 13 AS VARCHAR) AS vrlty_cost,
  CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE CAST(l_suppkey % 7 AS VARCHAR) END AS ovblc_cost,
  '.' || CAST(l_orderkey % 10 AS VARCHAR) AS ofxdc_cost,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS total_cost,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS mcc,
  'S' || CAST(l_suppkey AS VARCHAR) AS spn,
  CASE WHEN l_linenumber % 2 = 0 THEN strftime(o_orderdate, '%d-%b-%y')
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS latest_timestamp,
  o_orderpriority AS price_descriptor,
  CASE WHEN l_linenumber % 3 = 0 THEN 'AIR' ELSE 'SEA' END AS mot,
  'N' || CAST(n_nationkey AS VARCHAR) AS geo_code,
  'COUNTRY' AS geo_level,
  n_name AS country_name, r_name AS region, o_orderdate AS inserted_on
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
"""


def _norm_ts(c: str) -> str:
    parsed = f"try_strptime({c}, '%d-%b-%y')"
    century = f"CASE WHEN year({parsed}) < 2000 THEN {parsed} + INTERVAL 100 YEAR ELSE {parsed} END"
    return f"CASE WHEN {c} LIKE '%-___-%' THEN strftime({century}, '%Y-%m-%d') ELSE {c} END"


def _amount(c: str) -> str:
    return f"COALESCE(TRY_CAST({c} AS DOUBLE), CAST(0.0 AS DOUBLE))"


LANDED = (f"CAST({_amount('matrl_cost')} * (CAST(1.0 AS DOUBLE) + {_amount('malad_cost')} / CAST(100.0 AS DOUBLE))"
          f" + {_amount('vwrty_cost')} + {_amount('vtrdx_cost')} + {_amount('vrlty_cost')}"
          f" + {_amount('ovblc_cost')} + {_amount('ofxdc_cost')} AS DOUBLE)")

COST_COLS = ", ".join(COST_COLUMNS)

ORDER_LATEST = ("start_date DESC NULLS LAST, latest_timestamp DESC NULLS LAST, "
                "mcc DESC NULLS LAST, spn DESC NULLS LAST")


def _valid(source: str, lower_mark: str | None) -> str:
    mark = f" AND inserted_on > {lower_mark}" if lower_mark else ""
    computed = {"total_cost": "TRY_CAST(total_cost AS DOUBLE)", "latest_timestamp": _norm_ts("latest_timestamp"),
                "load_upto": "inserted_on"}
    cols = ", ".join(f"{computed[c]} AS {c}" if c in computed else c for c in COST_COLUMNS)
    return f"""SELECT {cols}
FROM {source}
WHERE cost_status NOT LIKE 'NOT%' AND TRY_CAST(matrl_cost AS DOUBLE) > 0
  AND start_date < {_AS_OF}{mark}"""


def _top1(source: str, where: str = "") -> str:
    return (f"SELECT * FROM {source} {where} QUALIFY row_number() OVER "
            f"(PARTITION BY product_id, country_name ORDER BY {ORDER_LATEST}) = 1")


_KEEP = (f"WHERE cost_status NOT LIKE 'NOT%' AND country_code IS NOT NULL AND product_id IS NOT NULL "
         f"AND start_date < {_AS_OF}")


def _finish(source: str) -> str:
    cols = COST_COLS.replace("total_cost", f"{LANDED} AS total_cost").replace(
        "load_upto", "max(load_upto) OVER () AS load_upto")
    return f"SELECT {cols} FROM {source}"


def _run(prefix: str, feed: str, previous: str | None, lower_mark: str | None) -> str:
    """CTEs of one cost run; the result is the CTE ``{prefix}_out``."""
    ctes = [f"{prefix}_valid AS ({_valid(feed, lower_mark)})",
            f"{prefix}_batch AS ({_top1(prefix + '_valid')})"]
    union = f"{prefix}_batch" if previous is None else \
        f"(SELECT {COST_COLS} FROM {prefix}_batch UNION ALL SELECT {COST_COLS} FROM {previous})"
    ctes.append(f"{prefix}_merged AS ({_top1(union, _KEEP)})")
    ctes.append(f"{prefix}_out AS ({_finish(prefix + '_merged')})")
    return ",\n".join(ctes)


_FEED_CTE = f"feed AS ({COST_FEED})"
_PREV_CTES = (f"{_FEED_CTE},\narrived AS (SELECT * FROM feed WHERE inserted_on <= {_WM}),\n"
              + _run("p", "arrived", None, None))

COST_SQL = {
    "cost_date_text": f"WITH {_FEED_CTE} SELECT product_id, mcc, spn, latest_timestamp, "
                      f"{_norm_ts('latest_timestamp')} AS normalised_timestamp FROM feed",
    "cost_valid_rows": f"WITH {_FEED_CTE} {_valid('feed', None)}",
    "cost_since_watermark": f"WITH {_FEED_CTE} SELECT product_id, mcc, spn, inserted_on FROM feed "
                            f"WHERE inserted_on > {_WM}",
    "cost_batch_latest": f"WITH {_FEED_CTE}, v AS ({_valid('feed', _WM)}) {_top1('v')}",
    "cost_landed": f"WITH {_FEED_CTE}, v AS ({_valid('feed', None)}) "
                   f"SELECT product_id, mcc, spn, {LANDED} AS total_cost FROM v",
    "cost_full_load": f"WITH {_FEED_CTE},\n{_run('f', 'feed', None, None)}\nSELECT * FROM f_out",
    "cost_high_water_mark": f"WITH {_PREV_CTES}\nSELECT max(load_upto) AS high_water_mark FROM p_out",
    "cost_merge_latest": (f"WITH {_PREV_CTES},\n"
                          + _run("m", "feed", "p_out", "(SELECT max(load_upto) FROM p_out)")
                          + "\nSELECT * FROM m_out"),
}

# ------------------------------------------------------------- cluster ----

_PERIOD = "CAST(year(l_shipdate) AS VARCHAR) || 'q' || CAST(quarter(l_shipdate) AS VARCHAR)"
CLUSTER_RAW = f"""
SELECT CASE WHEN l_partkey % 11 = 0 THEN 'X' || CAST(l_partkey % 1000 AS VARCHAR)
            WHEN l_partkey % 10 = 0 THEN 'p' || lpad(CAST(l_partkey AS VARCHAR), 6, '0')
            ELSE 'P' || lpad(CAST(l_partkey AS VARCHAR), 5, '0') END AS sku,
  CAST(l_suppkey % 5 AS INTEGER) AS cluster,
  CASE l_linenumber % 4 WHEN 0 THEN {_PERIOD} || ',' || lower(p_type)
       WHEN 1 THEN {_PERIOD} WHEN 2 THEN NULL ELSE lower(p_type) END AS path,
  l_quantity + l_discount AS size,
  {_PERIOD} AS quarter,
  CAST(l_suppkey % 6 AS INTEGER) AS feed,
  CAST(l_orderkey % 4 AS INTEGER) AS ctry,
  CASE WHEN l_orderkey % 3 = 0 THEN 'hp' WHEN l_orderkey % 3 = 1 THEN 'HP' ELSE 'other' END AS brand
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

_CLEAN = ("CASE WHEN path LIKE '2___q_,%' THEN substring(path, position(',' IN path) + 1) "
          "WHEN path LIKE '2___q_' THEN NULL ELSE path END")
_HP = "brand IN ('HP', 'hp')"


def _feed_sql(feed: int, country: str, size: str = "CAST(size AS DOUBLE)", brand: bool = True) -> str:
    where = f"feed = {feed}" + (f" AND {_HP}" if brand else "")
    return (f"SELECT sku AS SKU, cluster AS CLUSTER, {_CLEAN} AS PATH, {size} AS cluster_size, "
            f"replace(quarter, 'q', 'Q') AS fiscal_quarter, {country} AS country_code "
            f"FROM raw WHERE {where}")


_FEEDS = {
    "bps_emea_clustering": _feed_sql(
        0, "CASE ctry WHEN 0 THEN 'GB' WHEN 1 THEN 'FR' WHEN 2 THEN 'DE' ELSE 'spain' END"),
    "monitor_emea_clustering": _feed_sql(
        1, "CASE ctry WHEN 0 THEN 'GB' WHEN 1 THEN 'FR' WHEN 2 THEN 'DE' ELSE 'Spain' END"),
    "monitor_us_clustering": _feed_sql(2, "'US'", "CAST(CAST(size AS DECIMAL(10,0)) AS DOUBLE)"),
    "bps_na_clustering": _feed_sql(3, "CASE WHEN ctry IN (0, 1) THEN 'US' ELSE NULL END"),
    "print_france_clustering_time_v2": _feed_sql(4, "'FR'"),
    "print_uk_clustering_time_v8": _feed_sql(5, "'GB'", brand=False),
}
_ALLOWED = {
    "bps_emea_clustering": "('GB', 'FR', 'DE')",
    "monitor_emea_clustering": "('GB', 'FR', 'DE')",
    "monitor_us_clustering": "('US')",
    "bps_na_clustering": "('US')",
    "print_france_clustering_time_v2": "('FR')",
    "print_uk_clustering_time_v8": "('GB')",
}


def _union(distinct: bool) -> str:
    op = " UNION " if distinct else " UNION ALL "
    branches = [f"SELECT * FROM ({_FEEDS[n]}) WHERE country_code IN {_ALLOWED[n]}" for n in _FEEDS]
    inner = op.join(branches)
    return (f"SELECT upper(SKU) AS SKU, CLUSTER, PATH, cluster_size, "
            f"replace(fiscal_quarter, 'Q', 'Q0') AS fiscal_quarter, country_code FROM ({inner}) "
            f"WHERE length(upper(SKU)) IN (6, 7)")


_RAW_CTE = f"raw AS ({CLUSTER_RAW})"
_LATEST_PERIOD = ("SELECT SKU, country_code, coalesce(max(CASE WHEN PATH IS NOT NULL THEN fiscal_quarter END), "
                  "max(fiscal_quarter)) AS latest_fiscal_quarter FROM u GROUP BY SKU, country_code")

CLUSTER_SQL = {
    "cluster_clean_path": (f"WITH {_RAW_CTE} SELECT sku, path, {_CLEAN} AS cleaned_path, quarter, "
                           f"replace(replace(quarter, 'q', 'Q'), 'Q', 'Q0') AS fiscal_quarter FROM raw"),
    "cluster_conform": f"WITH {_RAW_CTE} " + " UNION ALL ".join(
        f"SELECT *, '{n}' AS feed FROM ({sql})" for n, sql in _FEEDS.items()),
    "cluster_union": f"WITH {_RAW_CTE} {_union(True)}",
    "cluster_latest_period": f"WITH {_RAW_CTE}, u AS ({_union(False)}) {_LATEST_PERIOD}",
    "cluster_latest_rows": (f"WITH {_RAW_CTE}, u AS ({_union(True)}), lp AS ({_LATEST_PERIOD}) "
                            "SELECT u.* FROM u JOIN lp ON u.SKU = lp.SKU AND u.country_code = lp.country_code "
                            "AND u.fiscal_quarter = lp.latest_fiscal_quarter"),
    "cluster_latest": f"""WITH {_RAW_CTE}, u AS ({_union(False)}), lp AS ({_LATEST_PERIOD}),
latest AS (
  SELECT u.* FROM u JOIN lp ON u.SKU = lp.SKU AND u.country_code = lp.country_code
    AND u.fiscal_quarter = lp.latest_fiscal_quarter
  QUALIFY row_number() OVER (PARTITION BY u.SKU, u.country_code
    ORDER BY (u.PATH IS NOT NULL) DESC, u.CLUSTER DESC NULLS LAST, u.cluster_size DESC NULLS LAST,
             u.PATH DESC NULLS LAST) = 1),
old AS (SELECT SKU, country_code, max(PATH) AS cluster_name FROM u GROUP BY SKU, country_code)
SELECT old.SKU AS product_number, latest.CLUSTER AS cluster_id, old.cluster_name,
  latest.cluster_size, old.country_code, latest.fiscal_quarter AS latest_fiscal_quarter,
  latest.PATH AS latest_cluster_name
FROM old LEFT JOIN latest ON old.SKU = latest.SKU AND old.country_code = latest.country_code""",
}

# ------------------------------------------------------ rates, geo, gt ----

RATES = """
SELECT n_name AS to_currency_name, 'CUR' || CAST(n_nationkey AS VARCHAR) AS to_currency_code,
  CASE WHEN o_orderkey % 7 = 0 THEN 'EUR' ELSE 'USD' END AS from_currency_code,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'pricing - IPG' WHEN '2-HIGH' THEN 'pricing - PSG'
       ELSE 'other' END AS use_case,
  o_orderstatus = 'F' AS is_latest,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS exchange_rate,
  CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS year_month, o_orderkey
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

GROUND_TRUTH = """
SELECT 'P' || lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS product_number,
  'C' || CAST(c_nationkey AS VARCHAR) AS country_code, l_orderkey, l_linenumber, l_extendedprice AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""

PRODUCT_DIM = """
SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS product_number, p_type AS family
FROM part WHERE p_partkey % 7 <> 0
UNION ALL
SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS product_number, p_type || '-ALT' AS family
FROM part WHERE p_partkey % 10 = 0
"""

_GT = f"gt AS (SELECT * FROM ({GROUND_TRUTH}) WHERE country_code IN ('C1', 'C2', 'C3', 'C4'))"


def _metric_rows() -> str:
    parts = ["SELECT '*' AS column_name, 'row_count' AS metric, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS value_text FROM gt"]
    for c, numeric in (("product_number", False), ("country_code", False), ("l_orderkey", True),
                       ("l_linenumber", True), ("price", True)):
        parts.append(f"SELECT '{c}', 'null_count', CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE), NULL FROM gt")
        parts.append(f"SELECT '{c}', 'distinct_count', CAST(count(DISTINCT {c}) AS DOUBLE), NULL FROM gt")
        for m in ("min", "max") if numeric else ():
            parts.append(f"SELECT '{c}', '{m}', CAST({m}({c}) AS DOUBLE), NULL FROM gt")
    return " UNION ALL ".join(parts)


_METRICS = f"m AS (SELECT 'ground_truth' AS table_name, * FROM ({_metric_rows()}))"
_RULES = "rules(table_name, column_name, metric, op, threshold, severity) AS (VALUES " + ", ".join(
    f"('{t}', '{c}', '{m}', '{o}', CAST({th} AS DOUBLE), '{s}')" for t, c, m, o, th, s in QC_RULES) + ")"
_RESULTS = """results AS (
  SELECT r.table_name, r.column_name, r.metric, m.value, r.op, r.threshold, r.severity,
    COALESCE(CASE r.op WHEN '<' THEN m.value < r.threshold WHEN '<=' THEN m.value <= r.threshold
      WHEN '=' THEN m.value = r.threshold WHEN '>=' THEN m.value >= r.threshold
      WHEN '>' THEN m.value > r.threshold WHEN '!=' THEN m.value <> r.threshold END, false) AS passed
  FROM rules r LEFT JOIN m ON r.table_name = m.table_name AND r.column_name = m.column_name
    AND r.metric = m.metric)"""

OTHER_SQL = {
    "fx_expand": f"""WITH rates AS ({RATES})
SELECT to_currency_code AS currency_code, to_currency_name AS currency_name,
  TRY_CAST(exchange_rate AS DOUBLE) AS exchange_rate,
  unnest(CASE WHEN use_case = 'pricing - IPG' THEN ['Print']
              WHEN use_case = 'pricing - PSG' THEN ['Business', 'Consumer']
              ELSE CAST([] AS VARCHAR[]) END) AS category,
  year_month
FROM rates
WHERE is_latest AND from_currency_code = 'USD' AND use_case IN ('pricing - IPG', 'pricing - PSG')""",
    "geo_snapshot": (f"SELECT n.*, r.*, {_NOW} AS created_on, CAST(NULL AS TIMESTAMP) AS updated_on "
                     "FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"),
    "audit_columns": (f"SELECT *, {_NOW} AS created_on, CAST(NULL AS TIMESTAMP) AS updated_on "
                      f"FROM ({PRODUCT_DIM})"),
    "gt_country_filter": f"WITH {_GT} SELECT * FROM gt",
    "gt_enrich_family": (f"WITH {_GT}, pd AS ({PRODUCT_DIM}) SELECT gt.*, pd.family FROM gt "
                         "LEFT JOIN pd ON gt.product_number = pd.product_number"),
    "qc_metrics": f"WITH {_GT}, {_METRICS} SELECT table_name, column_name, metric, value, value_text FROM m",
    "qc_results": f"WITH {_GT}, {_METRICS}, {_RULES}, {_RESULTS} SELECT * FROM results",
    "qc_status": (f"WITH {_GT}, {_METRICS}, {_RULES}, {_RESULTS} SELECT "
                  "CASE WHEN bool_or(NOT passed AND severity = 'ERROR') THEN 'ERROR' "
                  "WHEN bool_or(NOT passed) THEN 'WARN' ELSE 'PASS' END AS status, "
                  "count(*) FILTER (WHERE NOT passed) AS failed_rules FROM results"),
}

def _yy(c: str) -> str:
    """What ``dd-MMM-yy`` text of a date is read back as: Spark's ``yy`` is always 20yy."""
    return f"CASE WHEN year({c}) < 2000 THEN {c} + INTERVAL 100 YEAR ELSE {c} END"


# jobs and sinks: what the written tables must hold
_TEXT_FEED = f"""SELECT * REPLACE (
  CASE WHEN split_part(mcc, '-', 2) = '4' THEN NULL ELSE product_id END AS product_id,
  CASE WHEN country_name <> 'FRANCE' THEN country_name END AS country_name,
  CASE split_part(mcc, '-', 2) WHEN '1' THEN CAST({_yy('start_date')} AS DATE) WHEN '2' THEN NULL
       ELSE start_date END AS start_date,
  CASE split_part(mcc, '-', 2) WHEN '5' THEN NULL WHEN '6' THEN {_yy('inserted_on')}
       ELSE inserted_on END AS inserted_on) FROM feed"""
def _early(sql: str) -> str:
    return sql.replace(_AS_OF, f"DATE '{EARLY_AS_OF}'")


_DEFERRED = (f"WITH {_FEED_CTE},\narrived AS (SELECT * FROM feed WHERE inserted_on <= {_WM}),\n"
             + _early(_run("p", "arrived", None, None))
             + f""",
later AS (SELECT * FROM feed WHERE inserted_on > (SELECT max(load_upto) FROM p_out)
          UNION SELECT * FROM arrived WHERE start_date >= DATE '{EARLY_AS_OF}'),
""" + _run("m", "later", "p_out", None) + "\nSELECT * FROM m_out")


def _history() -> str:
    value = {"row_count": "count(*)", "null_count": "count(*) FILTER (WHERE {c} IS NULL)"}
    parts = []
    for t, c, m, runs, most in HISTORY_RULES:
        v = value[m].format(c=c)
        parts.append(f"""SELECT run_id, '{t}' AS table_name, '{c}' AS column_name, '{m}' AS metric, value,
  avg(value) OVER w AS baseline, {runs} AS runs, CAST({most} AS DOUBLE) AS most,
  coalesce(abs(value - avg(value) OVER w) <= CAST({most} AS DOUBLE) * abs(avg(value) OVER w), true) AS passed
FROM (SELECT CAST(year(inserted_on) AS VARCHAR) AS run_id, CAST({v} AS DOUBLE) AS value FROM feed GROUP BY 1)
WINDOW w AS (ORDER BY run_id ROWS BETWEEN {runs} PRECEDING AND 1 PRECEDING)""")
    return f"WITH {_FEED_CTE} " + " UNION ALL ".join(f"({p})" for p in parts)


_SKETCHES = f"WITH gt AS ({GROUND_TRUTH}) " + " UNION ALL ".join(
    f"SELECT 'ground_truth' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"count(DISTINCT {c}) AS exact_distinct, true AS within_bound FROM gt"
    for c in ("product_number", "country_code", "l_orderkey", "l_linenumber", "price"))

_DRIFT = f"""WITH gt AS ({GROUND_TRUTH})
SELECT product_number, CASE WHEN l_linenumber <= 3 THEN country_code END AS country_code,
  CASE WHEN l_linenumber <= 3 OR l_orderkey % 50 <> 0 THEN CAST(l_orderkey AS BIGINT) END AS l_orderkey,
  CAST(l_linenumber AS INTEGER) AS l_linenumber,
  CASE WHEN l_linenumber <= 3 THEN price ELSE CAST(CAST(price AS DECIMAL(12,2)) AS DOUBLE) END AS price,
  CASE WHEN l_linenumber > 3 THEN CAST(l_orderkey % 3 AS VARCHAR) END AS promo,
  CASE WHEN l_linenumber > 3 AND l_orderkey % 50 = 0 THEN 'K' || CAST(l_orderkey AS VARCHAR) END AS bad_orderkey FROM gt"""

def _steps() -> str:
    waiting = _valid("feed", _WM).replace(f"start_date < {_AS_OF}", f"start_date >= {_AS_OF}")
    steps = {"new": "SELECT * FROM s_valid", "waiting": waiting, "batch": "SELECT * FROM s_batch",
             "dropped": "SELECT * FROM s_batch EXCEPT ALL SELECT * FROM s_batch " + _KEEP, "result": "SELECT * FROM s_out"}
    return (f"WITH {_FEED_CTE},\n{_run('s', 'feed', None, _WM)}\n" + " UNION ALL ".join(
        f"SELECT '{name}' AS step, count(*) AS rows, count(DISTINCT {{'p': product_id, 'c': country_name}}) AS keys, "
        f"max(start_date) AS latest FROM ({sql})" for name, sql in steps.items()))


JOB_SQL = {
    "cost_steps_sql": _steps(),
    "cost_job_rewrite": COST_SQL["cost_merge_latest"],
    "cost_job_deferred": _DEFERRED,
    "cost_job_mark": COST_SQL["cost_merge_latest"].replace("SELECT * FROM m_out", "SELECT max(load_upto) AS high_water_mark FROM m_out"),
    "qc_history": _history(),
    "qc_sketch_merge": _SKETCHES,
    "feed_drift": _DRIFT,
    "cost_text_feed": f"WITH {_FEED_CTE}, texts AS ({_TEXT_FEED}) {_valid('texts', _WM)}",
    "cost_job_two_runs": COST_SQL["cost_merge_latest"],
    "cluster_job": CLUSTER_SQL["cluster_latest"],
    "rates_job": OTHER_SQL["fx_expand"],
    "geo_job": OTHER_SQL["geo_snapshot"],
    "ground_truth_job": OTHER_SQL["gt_enrich_family"],
    "qc_gate_outcome": f"""WITH {_GT}, pd AS ({PRODUCT_DIM})
SELECT 'failing rule' AS rule, 'FAILED' AS status, 'ERROR' AS log_level, CAST(0 AS BIGINT) AS rows_written
UNION ALL SELECT 'passing rule', 'SUCCESS', 'INFO',
  (SELECT count(*) FROM gt LEFT JOIN pd ON gt.product_number = pd.product_number)""",
    "dedupe_product": (f"SELECT product_number, max(family) AS family FROM ({PRODUCT_DIM}) GROUP BY product_number"),
    "write_append_ignore": f"WITH p AS ({PRODUCT_DIM}) SELECT * FROM p UNION ALL SELECT product_number, upper(family) FROM p",
    "audit_roundtrip": GROUND_TRUTH,
}

# the join form of the merge must give exactly the same table
COST_SQL["cost_merge_latest_join"] = COST_SQL["cost_merge_latest"]

ORACLE_SQL: dict[str, str] = {**COST_SQL, **CLUSTER_SQL, **OTHER_SQL, **JOB_SQL}
