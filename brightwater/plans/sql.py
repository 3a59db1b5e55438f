"""Shared pieces of the SQL equivalents."""

from __future__ import annotations

AS_OF = "2001-12-01"

CE = """ce AS (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS event_id,
         concat('C', CAST(o_custkey AS VARCHAR)) AS customer_id, 'purchase' AS event_type,
         r_name AS region, concat('P', CAST(l_partkey AS VARCHAR)) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice * (1 - l_discount) AS revenue,
         l_linenumber * 60 AS session_duration_sec, l_shipdate AS timestamp, CAST(NULL AS VARCHAR) AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

FLAWED = """flawed AS (
  SELECT CASE WHEN l_tax = 0.08 AND l_linenumber = 1 THEN NULL
              ELSE concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) END AS event_id,
         CASE WHEN l_tax = 0.07 AND l_linenumber = 2 THEN NULL
              ELSE concat('S', CAST(l_suppkey AS VARCHAR)) END AS customer_id,
         CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'purchase' END AS event_type,
         CASE WHEN l_tax = 0.0 THEN NULL ELSE l_linestatus END AS region,
         concat('P', CAST(l_partkey AS VARCHAR)) AS product_id,
         CASE WHEN l_quantity = 50 THEN -50 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         CASE WHEN l_discount = 0.1 THEN -l_extendedprice WHEN l_discount = 0.09 THEN NULL
              ELSE l_extendedprice END AS revenue,
         l_linenumber * 60 AS session_duration_sec,
         CASE WHEN l_tax = 0.06 AND l_linenumber = 3 THEN NULL ELSE l_shipdate END AS timestamp,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date
  FROM lineitem)"""

MANDATORY = "event_id IS NOT NULL AND customer_id IS NOT NULL AND timestamp IS NOT NULL"
PLAUSIBLE = "(revenue IS NULL OR revenue >= 0) AND (quantity IS NULL OR quantity >= 0)"

EVENT_OUT = """event_id, customer_id, event_type, region, product_id, quantity, revenue, session_duration_sec,
  strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS event_time, date"""


def latest(source: str, name: str = "clean", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, rank() OVER (PARTITION BY event_id ORDER BY timestamp DESC) AS rk FROM {source} WHERE {where})
  WHERE rk = 1)"""


def dated(source: str, name: str = "dated") -> str:
    return f"""{name} AS (
  SELECT * REPLACE (CASE WHEN (SELECT count(*) FROM {source} WHERE date IS NULL) > 0
                         THEN strftime(timestamp, '%Y-%m-%d') ELSE date END AS date) FROM {source})"""


CLEAN_FLAWED = f"""{FLAWED},
{latest("flawed", "clean", f"{MANDATORY} AND {PLAUSIBLE}")},
{dated("clean")}"""


def customer_features(as_of: str = AS_OF, source: str = "ce") -> str:
    return f"""agg AS (
  SELECT customer_id, region, count(event_id) AS total_events, count(DISTINCT product_id) AS unique_products,
         sum(revenue) AS total_revenue, avg(revenue) AS avg_order_value, avg(session_duration_sec) AS avg_session_sec,
         max(timestamp) AS last_event_ts, min(timestamp) AS first_event_ts,
         count(DISTINCT CAST(timestamp AS DATE)) AS active_days
  FROM {source} GROUP BY customer_id, region),
recency AS (
  SELECT *, CAST(date_diff('day', CAST(last_event_ts AS DATE), DATE '{as_of}') AS INTEGER) AS days_since_last_event,
         CAST(date_diff('day', CAST(first_event_ts AS DATE), DATE '{as_of}') AS INTEGER) AS customer_tenure_days
  FROM agg),
scored AS (
  SELECT *, greatest(CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) - days_since_last_event / CAST(180 AS DOUBLE)) AS recency_score
  FROM recency),
features AS (
  SELECT *, recency_score * CAST(0.4 AS DOUBLE) + (active_days / CAST(90 AS DOUBLE)) * CAST(0.3 AS DOUBLE)
            + least(total_events / CAST(100 AS DOUBLE), CAST(1 AS DOUBLE)) * CAST(0.3 AS DOUBLE) AS engagement_score
  FROM scored)"""


def demand(source: str = "ce") -> str:
    return f"""daily AS (
  SELECT strftime(timestamp, '%Y-%m-%d') AS date, product_id, region, CAST(sum(quantity) AS BIGINT) AS daily_units,
         sum(revenue) AS daily_revenue, count(DISTINCT customer_id) AS daily_unique_buyers
  FROM {source} GROUP BY ALL)"""


def rolling(frame: str = "rows") -> str:
    columns = []
    for n in (7, 14, 30):
        if frame == "rows":
            over = f"(PARTITION BY product_id, region ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        else:
            over = (
                "(PARTITION BY product_id, region ORDER BY CAST(date AS DATE) RANGE BETWEEN "
                f"INTERVAL {n} DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)"
            )
        columns.append(f"sum(daily_revenue) OVER {over} AS revenue_rolling_{n}d")
        columns.append(f"CAST(sum(daily_units) OVER {over} AS BIGINT) AS units_rolling_{n}d")
    return f"demand AS (SELECT *, {', '.join(columns)} FROM daily)"


def r(expression: str, alias: str | None = None, places: int = 4) -> str:
    """Counterpart of ``registry.rounded``."""
    name = alias or expression
    return f"round(CAST({expression} AS DOUBLE) + 1e-7, {places}) AS {name}"


DEMAND_OUT = ", ".join(
    ["date", "product_id", "region", "daily_units", "round(daily_revenue, 4) AS daily_revenue", "daily_unique_buyers"]
    + [f"round(revenue_rolling_{n}d, 4) AS revenue_rolling_{n}d, units_rolling_{n}d" for n in (7, 14, 30)]
)

CONTRACTS = """contracts AS (
  SELECT o_orderkey AS doc_id,
    concat('Buyer ', CAST(o_custkey AS VARCHAR),
      CASE WHEN o_orderstatus = 'F' THEN ' shall pay Northwind Traders Inc. $'
           WHEN o_orderstatus = 'O' THEN ' may owe Harbor Freight Lines Ltd. $'
           ELSE ' agrees to send Acme Corporation $' END,
      CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), ' by ', strftime(o_orderdate, '%Y-%m-%d'), '. ',
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'The seller must deliver within 30 days! '
           ELSE 'Delivery was on January 31, 2025. ' END,
      'Questions go to desk', CAST(o_custkey AS VARCHAR), '@example.com or https://example.com/o/',
      CAST(o_orderkey AS VARCHAR)) AS text
  FROM orders)"""
