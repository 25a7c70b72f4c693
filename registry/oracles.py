"""SQL for a second engine, one statement per query, over the same tables."""

from __future__ import annotations

from .star_schema import HOLIDAYS, LINE_OUTLIER, ORDER_OUTLIER, SNAPSHOT_DAYS

ORACLES: dict[str, str] = {}
ZERO = "CAST(0 AS DOUBLE)"


def money(expression: str, digits: int = 2) -> str:
    return f"round({expression} + {ZERO}, {digits})"


def monies(*columns: str, digits: int = 2) -> str:
    return ", ".join(f"{money(c, digits)} AS {c}" for c in columns)


# --- snapshots and logs --------------------------------------------------------
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
SHIPMENT_COLUMNS = ["l_linenumber", "l_returnflag", "l_linestatus", "l_quantity"]


def in_snapshot(event_day: str, day: str) -> str:
    archived = "" if day == SNAPSHOT_DAYS[0] else f" AND {event_day} > CAST(DATE '{day}' - INTERVAL 48 MONTH AS DATE)"
    return f"{event_day} <= DATE '{day}'{archived}"


def orders_as_of(day: str) -> str:
    return f"""(SELECT o_orderkey, o_custkey,
        CASE WHEN CAST(o_orderdate AS DATE) > DATE '{day}' - 60 THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
        o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
      FROM orders WHERE {in_snapshot("CAST(o_orderdate AS DATE)", day)})"""


def shipments_as_of(day: str) -> str:
    return f"""(SELECT l_linenumber, l_returnflag, l_linestatus, CAST(l_quantity AS INTEGER) AS l_quantity
      FROM lineitem WHERE {in_snapshot("CAST(l_shipdate AS DATE)", day)})"""


def keyed_changes(now: str, before: str | None) -> str:
    if before is None:
        return f"SELECT *, 'I' AS Op, '{now}' AS cdc_snapshot_dt FROM {orders_as_of(now)}"
    image = ", ".join(f"CASE WHEN c.o_orderkey IS NULL THEN p.{c} ELSE c.{c} END AS {c}" for c in ORDER_COLUMNS)
    differs = " OR ".join(f"c.{c} IS DISTINCT FROM p.{c}" for c in ORDER_COLUMNS)
    return f"""SELECT {image},
        CASE WHEN p.o_orderkey IS NULL THEN 'I' WHEN c.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS Op,
        '{now}' AS cdc_snapshot_dt
      FROM {orders_as_of(now)} c FULL OUTER JOIN {orders_as_of(before)} p ON c.o_orderkey = p.o_orderkey
      WHERE {differs}"""


DAY1, DAY2, DAY3 = SNAPSHOT_DAYS
KEYED_HISTORY = " UNION ALL ".join(
    f"({keyed_changes(now, before)})" for now, before in ((DAY1, None), (DAY2, DAY1), (DAY3, DAY2))
)


def multiset_changes(now: str, before: str) -> str:
    new, old = shipments_as_of(now), shipments_as_of(before)
    return f"""SELECT *, 'I' AS Op, '{now}' AS cdc_snapshot_dt FROM (SELECT * FROM {new} EXCEPT ALL SELECT * FROM {old})
      UNION ALL SELECT *, 'D' AS Op, '{now}' AS cdc_snapshot_dt
      FROM (SELECT * FROM {old} EXCEPT ALL SELECT * FROM {new})"""


HASHED = ["o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"]  # in name order
ORDERS3 = ", ".join(money(c) + f" AS {c}" if c == "o_totalprice" else c for c in ORDER_COLUMNS)

ORACLES["normalize_columns"] = "SELECT * FROM orders"
ORACLES["cdc_repeated_keys"] = " UNION ALL ".join(
    f"SELECT '{day}' AS snapshot_dt, l_orderkey, l_linenumber, count(*) AS copies FROM lineitem "
    f"WHERE {in_snapshot('CAST(l_shipdate AS DATE)', day)} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
    for day in SNAPSHOT_DAYS
)
ORACLES["row_hash"] = f"""
SELECT o_orderkey, sha256(concat_ws('||', {", ".join(f"coalesce(CAST({c} AS VARCHAR), '__NULL__')" for c in HASHED)}))
  AS row_hash FROM orders"""
ORACLES["row_hash_exact"] = f"""
SELECT o_orderkey, sha256(concat({", ".join(
    f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')" for c in HASHED)})) AS row_hash
FROM orders"""
ORACLES["cdc_baseline"] = f"SELECT *, 'I' AS Op, '{DAY1}' AS cdc_snapshot_dt FROM {shipments_as_of(DAY1)}"
ORACLES["cdc_keyed_diff"] = f"SELECT {ORDERS3}, Op, cdc_snapshot_dt FROM ({keyed_changes(DAY2, DAY1)})"
ORACLES["cdc_multiset_diff"] = multiset_changes(DAY2, DAY1)
ORACLES["cdc_diff_range"] = f"SELECT {ORDERS3}, Op, cdc_snapshot_dt FROM ({KEYED_HISTORY})"
ORACLES["cdc_op_counts"] = f"SELECT Op, count(*) AS n FROM ({keyed_changes(DAY3, DAY2)}) GROUP BY Op"
ORACLES["cdc_headers"] = f"""
WITH h AS (SELECT *, lpad(CAST(CAST(epoch(CAST(cdc_snapshot_dt AS TIMESTAMP)) AS BIGINT) AS VARCHAR), 15, '0') AS batch
           FROM ({KEYED_HISTORY}))
SELECT cdc_snapshot_dt, Op, min(batch) AS first_batch, max(batch) AS last_batch, 35 AS seq_length,
       count(*) AS sequences, count(*) AS changes, cdc_snapshot_dt || ' 00:00:00' AS commit_ts, count(*) AS stamped
FROM h GROUP BY cdc_snapshot_dt, Op"""
ORACLES["snapshot_dates"] = f"""
SELECT snapshot_dt, lag(snapshot_dt) OVER (ORDER BY snapshot_dt) AS previous_dt, n
FROM ({" UNION ALL ".join(f"SELECT '{d}' AS snapshot_dt, count(*) AS n FROM {shipments_as_of(d)}" for d in SNAPSHOT_DAYS)})"""
ORACLES["cdc_log_io"] = f"""
SELECT cdc_snapshot_dt, Op, l_returnflag, count(*) AS n FROM (
  {ORACLES["cdc_baseline"]} UNION ALL {multiset_changes(DAY2, DAY1)} UNION ALL {multiset_changes(DAY3, DAY2)})
GROUP BY ALL"""
ORACLES["collapse_keyed"] = f"SELECT {ORDERS3} FROM {orders_as_of(DAY3)}"
ORACLES["collapse_multiset"] = f"SELECT * FROM {shipments_as_of(DAY3)}"
ORACLES["collapse_incremental"] = ORACLES["collapse_keyed"]
ORACLES["collapse_incremental_multiset"] = ORACLES["collapse_multiset"]
ORACLES["cdc_roundtrip"] = f"""
SELECT 'orders_by_key' AS table_name, 2 * count(*) AS rows, CAST(0 AS BIGINT) AS unmatched FROM {orders_as_of(DAY3)}
UNION ALL
SELECT 'shipments', 2 * count(*), CAST(0 AS BIGINT) FROM {shipments_as_of(DAY3)}"""
ORACLES["adapt_change_feed"] = """
WITH feed AS (SELECT l_orderkey AS order_id, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped, l_returnflag,
    row_number() OVER (PARTITION BY l_orderkey
      ORDER BY CAST(l_shipdate AS DATE) DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS place
  FROM lineitem)
SELECT order_id, quantity, shipped FROM feed WHERE place = 1 AND l_returnflag <> 'R'"""

# --- calendar ------------------------------------------------------------------
NAMES = " ".join(f"WHEN day LIKE '%{md}' AND o_orderstatus = 'F' THEN '{name}'" for md, name in HOLIDAYS.items())
CALENDAR = f"""
bounds AS (SELECT min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders),
listed AS (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus FROM orders),
flagged AS (SELECT CAST(day AS DATE) AS date_key, CASE {NAMES} END AS name FROM listed),
holidays AS (SELECT date_key, max(name) IS NOT NULL AS is_holiday, max(name) AS holiday_name FROM flagged GROUP BY date_key),
days AS (SELECT CAST(unnest(generate_series(CAST(make_date(year(first_day), 1, 1) AS TIMESTAMP),
    CAST(make_date(year(last_day), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_key FROM bounds),
attributes AS (SELECT date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month,
    CAST(weekofyear(date_key) AS INTEGER) AS week, dayname(date_key) AS day_of_week,
    dayofweek(date_key) IN (0, 6) AS is_weekend FROM days),
date_dim AS (SELECT a.*, coalesce(h.is_holiday, FALSE) AS is_holiday, h.holiday_name
    FROM attributes a LEFT JOIN holidays h USING (date_key))"""
ORACLES["date_bounds"] = f"WITH {CALENDAR} SELECT min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders JOIN lineitem ON l_orderkey = o_orderkey"
ORACLES["holiday_dim"] = f"WITH {CALENDAR} SELECT * FROM holidays"
ORACLES["date_attributes"] = f"WITH {CALENDAR} SELECT a.* FROM attributes a, bounds WHERE date_key BETWEEN first_day AND last_day"
ORACLES["date_dim"] = f"WITH {CALENDAR} SELECT * FROM date_dim"

# --- facts -----------------------------------------------------------------------
FACTS = f"""
items AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, concat_ws('-', l_linenumber, l_partkey, l_suppkey) AS lineitem_id,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_custkey AS VARCHAR) END AS user_id,
    CAST(c_nationkey AS VARCHAR) AS restaurant_id, c_mktsegment AS app_name, 'USD' AS currency,
    o_orderpriority = '1-URGENT' AS is_loyalty, CAST(o_orderdate AS VARCHAR) AS creation_time_utc,
    p_type AS item_category, p_name AS item_name, p_retailprice AS item_price, CAST(l_quantity AS INTEGER) AS item_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey),
options AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, concat_ws('-', l_linenumber, l_partkey, l_suppkey) AS lineitem_id,
    unnest(CASE WHEN p_type = 'PROMO' THEN [l_tax, -l_discount] ELSE [l_tax] END) AS option_price,
    l_quantity AS option_quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey),
per_line AS (SELECT order_id, lineitem_id, sum(option_price * option_quantity) AS opt_total,
    sum(CASE WHEN option_price < 0 THEN option_price * option_quantity ELSE {ZERO} END) AS opt_minus,
    sum(CASE WHEN option_price > 0 THEN option_price * option_quantity ELSE {ZERO} END) AS opt_plus
  FROM options GROUP BY order_id, lineitem_id),
lines AS (SELECT i.*, item_price * item_quantity AS item_amount, coalesce(opt_minus, {ZERO}) AS options_discount,
    item_price * item_quantity + coalesce(opt_plus, {ZERO}) AS gross_revenue,
    coalesce(opt_minus, {ZERO}) AS discount_amount,
    item_price * item_quantity + coalesce(opt_total, {ZERO}) AS net_revenue,
    coalesce(opt_minus, {ZERO}) < 0 AS is_discounted,
    item_price * item_quantity + coalesce(opt_total, {ZERO}) > {LINE_OUTLIER} AS is_outlier
  FROM items i LEFT JOIN per_line p ON i.order_id = p.order_id AND i.lineitem_id = p.lineitem_id),
rolled AS (SELECT order_id,
    {", ".join(f"arg_min({a}, lineitem_id) FILTER (WHERE {a} IS NOT NULL) AS {a}" for a in
      ("user_id", "restaurant_id", "app_name", "currency", "is_loyalty", "creation_time_utc"))},
    sum(net_revenue) AS order_revenue, sum(gross_revenue) AS order_gross_revenue,
    sum(discount_amount) AS order_discount_amount, count(*) AS line_item_count,
    CAST(sum(item_quantity) AS DOUBLE) AS total_item_quantity
  FROM lines GROUP BY order_id),
facts AS (SELECT *, CAST(creation_time_utc AS TIMESTAMP) AS order_ts, CAST(creation_time_utc AS DATE) AS order_date,
    order_discount_amount < 0 AS is_discounted, order_revenue > {ORDER_OUTLIER} AS is_outlier FROM rolled),
regular AS (SELECT * FROM facts WHERE NOT is_outlier),
named AS (SELECT * FROM regular WHERE user_id IS NOT NULL),
as_of AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders)"""
LINE_COLUMNS = """order_id, lineitem_id, user_id, restaurant_id, app_name, currency, is_loyalty, creation_time_utc,
  item_category, item_name"""
ORACLES["line_item_facts"] = f"""WITH {FACTS} SELECT {LINE_COLUMNS}, item_quantity, is_discounted, is_outlier,
  {monies("item_price", "item_amount", "options_discount", "gross_revenue", "discount_amount", "net_revenue")} FROM lines"""
ORACLES["order_facts"] = f"""WITH {FACTS} SELECT order_id, user_id, restaurant_id, app_name, currency, is_loyalty,
  creation_time_utc, line_item_count, strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts, order_date, is_discounted, is_outlier,
  {monies("order_revenue", "order_gross_revenue", "order_discount_amount", "total_item_quantity")} FROM facts"""


# --- customers -------------------------------------------------------------------
def dense(orders: str, first: str, last: str) -> str:
    """CTEs ending in ``clv``: the plain shape, every customer against every day."""
    return f"""
spine AS (SELECT CAST(unnest(generate_series(CAST({first} AS TIMESTAMP), CAST({last} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS clv_date),
firsts AS (SELECT user_id, min(order_date) AS first_order_date FROM {orders} GROUP BY user_id),
daily AS (SELECT user_id, order_date, sum(order_revenue) AS r, count(*) AS n FROM {orders} GROUP BY user_id, order_date),
filled AS (SELECT f.user_id, clv_date, first_order_date, coalesce(r, {ZERO}) AS daily_revenue, coalesce(n, 0) AS daily_order_count
  FROM firsts f JOIN spine ON clv_date >= first_order_date
    LEFT JOIN daily d ON d.user_id = f.user_id AND d.order_date = clv_date),
clv AS (SELECT user_id, clv_date, strftime(clv_date, '%Y-%m') AS clv_month, first_order_date, daily_revenue, daily_order_count,
    sum(daily_revenue) OVER w AS cumulative_clv, CAST(sum(daily_order_count) OVER w AS BIGINT) AS cumulative_order_count
  FROM filled WINDOW w AS (PARTITION BY user_id ORDER BY clv_date ROWS UNBOUNDED PRECEDING))"""


PURCHASES = f"""purchases AS (SELECT CAST(user_id AS VARCHAR) AS user_id, value AS order_revenue, CAST(ts AS DATE) AS order_date
  FROM events WHERE event_type = 'purchase'), {dense("purchases", "(SELECT min(order_date) FROM purchases)", "(SELECT max(order_date) FROM purchases)")}"""
ORDER_CLV = f"""{FACTS}, {dense("named", "(SELECT min(CAST(o_orderdate AS DATE)) FROM orders)", "(SELECT d FROM as_of)")}"""
CLV_COLUMNS = f"""user_id, clv_date, clv_month, first_order_date, daily_order_count, cumulative_order_count,
  {monies("daily_revenue", "cumulative_clv")}"""
ORACLES["clv_daily_full"] = f"WITH {PURCHASES} SELECT {CLV_COLUMNS} FROM clv"
ORACLES["clv_daily_opening"] = f"WITH {PURCHASES} SELECT {CLV_COLUMNS} FROM clv WHERE clv_date >= (SELECT min(order_date) + 14 FROM purchases)"
ORACLES["clv_daily_incremental"] = f"""WITH {FACTS},
  {dense("named", "(SELECT min(order_date) FROM named)", "(SELECT max(order_date) FROM named)")}
SELECT clv_month, count(*) AS customer_days, {money("sum(daily_revenue)")} AS revenue,
  CAST(sum(daily_order_count) AS BIGINT) AS orders, {money("sum(cumulative_clv)")} AS clv_days,
  max(cumulative_order_count) AS most_orders, min(first_order_date) AS oldest_customer FROM clv GROUP BY clv_month"""
ORACLES["clv_trends"] = f"""WITH {ORDER_CLV}
SELECT clv_date, {money("sum(cumulative_clv)")} AS total_cumulative_clv, {money("avg(cumulative_clv) * count(*)")} / count(*) AS avg_cumulative_clv,
  {money("sum(daily_revenue)")} AS daily_revenue, count(*) AS active_customers,
  count(*) FILTER (WHERE clv_date = first_order_date) AS new_customers FROM clv GROUP BY clv_date"""
TIERS = f"""{FACTS},
lifetime AS (SELECT user_id, sum(order_revenue) AS total_clv, count(*) AS total_orders FROM named GROUP BY user_id),
quintiles AS (SELECT *, CAST(ntile(5) OVER (ORDER BY total_clv DESC NULLS LAST, user_id) AS INTEGER) AS clv_quintile FROM lifetime),
tiers AS (SELECT *, CASE WHEN clv_quintile = 1 THEN 'High' WHEN clv_quintile = 5 THEN 'Low' ELSE 'Medium' END AS clv_tier FROM quintiles)"""
ORACLES["customer_clv_tiers"] = f"""WITH {TIERS}
SELECT user_id, {monies("total_clv")}, total_orders, clv_quintile, clv_tier FROM tiers"""
RFM = f"""{FACTS},
measures AS (SELECT user_id, any_value(d) AS as_of_date, max(order_date) AS last_order_date,
    CAST(date_diff('day', max(order_date), any_value(d)) AS INTEGER) AS recency_days,
    count(*) FILTER (WHERE order_date BETWEEN CAST(d - INTERVAL 12 MONTH AS DATE) AND d) AS frequency,
    coalesce(sum(order_revenue) FILTER (WHERE order_date BETWEEN CAST(d - INTERVAL 12 MONTH AS DATE) AND d), {ZERO}) AS monetary
  FROM named, as_of GROUP BY user_id),
scored AS (SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS LAST, user_id) AS INTEGER) AS r_score,
    CAST(ntile(5) OVER (ORDER BY frequency ASC NULLS FIRST, user_id) AS INTEGER) AS f_score,
    CAST(ntile(5) OVER (ORDER BY monetary ASC NULLS FIRST, user_id) AS INTEGER) AS m_score FROM measures),
rfm AS (SELECT *, r_score + f_score + m_score AS rfm_score, 12 AS lookback_months,
    CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP' WHEN r_score >= 4 AND f_score <= 2 THEN 'New'
         WHEN r_score <= 2 AND f_score <= 2 THEN 'Churn Risk' ELSE 'Regular' END AS rfm_segment FROM scored)"""
ORACLES["customer_rfm"] = f"""WITH {RFM}
SELECT user_id, as_of_date, last_order_date, recency_days, frequency, {monies("monetary")}, r_score, f_score, m_score,
  rfm_score, rfm_segment, lookback_months FROM rfm"""
CHURN = f"""{FACTS},
profile AS (SELECT user_id, any_value(d) AS as_of_date, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
    count(*) AS total_orders, CAST(date_diff('day', max(order_date), any_value(d)) AS INTEGER) AS days_since_last_order,
    CASE WHEN count(*) > 1 THEN CAST(date_diff('day', min(order_date), max(order_date)) AS DOUBLE) / (count(*) - 1) END AS avg_gap_days,
    coalesce(sum(order_revenue) FILTER (WHERE order_date > d - 30 AND order_date <= d), {ZERO}) AS recent_spend,
    coalesce(sum(order_revenue) FILTER (WHERE order_date > d - 60 AND order_date <= d - 30), {ZERO}) AS prior_spend
  FROM named, as_of GROUP BY user_id),
churn AS (SELECT *, CASE WHEN prior_spend > 0 THEN (recent_spend - prior_spend) / prior_spend * 100 END AS spend_change_pct,
    CASE WHEN days_since_last_order <= 45 THEN 'Active' WHEN days_since_last_order <= 90 THEN 'At Risk' ELSE 'Dormant' END AS churn_status,
    days_since_last_order > 45 AS at_risk FROM profile)"""
ORACLES["churn_indicators"] = f"""WITH {CHURN}
SELECT user_id, as_of_date, first_order_date, last_order_date, total_orders, days_since_last_order,
  {monies("avg_gap_days", "spend_change_pct", digits=6)}, {monies("recent_spend", "prior_spend")}, churn_status, at_risk FROM churn"""
LOYALTY = f"""{FACTS},
customer_spend AS (SELECT user_id, bool_or(is_loyalty) AS is_loyalty_member, count(*) AS n, sum(order_revenue) AS spend
  FROM named GROUP BY user_id),
loyalty AS (SELECT CASE WHEN is_loyalty_member THEN 'Loyalty' ELSE 'Non-Loyalty' END AS segment, is_loyalty_member,
    count(DISTINCT user_id) AS customers, CAST(sum(n) AS BIGINT) AS total_orders, sum(spend) AS total_revenue,
    sum(spend) / sum(n) AS avg_order_value, avg(n) AS avg_orders_per_customer, avg(spend) AS avg_clv,
    avg(CASE WHEN n > 1 THEN CAST(1 AS DOUBLE) ELSE {ZERO} END) AS repeat_rate
  FROM customer_spend GROUP BY is_loyalty_member)"""
ORACLES["loyalty_impact"] = f"""WITH {LOYALTY}
SELECT segment, is_loyalty_member, customers, total_orders, {monies("total_revenue")},
  {monies("avg_order_value", "avg_orders_per_customer", "avg_clv", "repeat_rate", digits=6)} FROM loyalty"""

# --- commerce --------------------------------------------------------------------
SALES = f"""{CALENDAR}, {FACTS},
sales AS (SELECT s.*, c.year, c.month, c.week, c.day_of_week, c.is_weekend, c.is_holiday, c.holiday_name FROM (
    SELECT CAST(creation_time_utc AS DATE) AS order_date, restaurant_id, item_category, sum(net_revenue) AS revenue,
      sum(gross_revenue) AS gross_revenue, sum(discount_amount) AS discount_amount,
      CAST(sum(item_quantity) AS DOUBLE) AS quantity, count(DISTINCT order_id) AS order_count, count(*) AS line_item_count
    FROM lines WHERE NOT is_outlier GROUP BY ALL) s LEFT JOIN date_dim c ON c.date_key = s.order_date)"""
SUMS = f"""{", ".join(f"{money(f'sum({c})')} AS {c}" for c in ("revenue", "gross_revenue", "discount_amount", "quantity"))},
  CAST(sum(line_item_count) AS BIGINT) AS line_item_count"""
ORACLES["sales_daily"] = f"""WITH {SALES}
SELECT order_date, restaurant_id, item_category, {monies("revenue", "gross_revenue", "discount_amount", "quantity")},
  order_count, line_item_count, year, month, week, day_of_week, is_weekend, is_holiday, holiday_name FROM sales"""
ORACLES["sales_rollup_weekly"] = f"""WITH {SALES}
SELECT CAST(date_trunc('week', order_date) AS DATE) AS period_start, {SUMS} FROM sales GROUP BY 1"""
ORACLES["sales_rollup_slices"] = f"""WITH {SALES}
SELECT CAST(date_trunc('month', order_date) AS DATE) AS period_start, day_of_week, is_holiday, {SUMS} FROM sales GROUP BY 1, 2, 3"""
LOCATIONS = f"""{FACTS},
location AS (SELECT restaurant_id, sum(order_revenue) AS total_revenue, count(*) AS order_count,
    count(DISTINCT user_id) AS unique_customers, sum(order_revenue) / count(*) AS avg_order_value FROM regular GROUP BY restaurant_id),
locations AS (SELECT *, CAST(dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank FROM location)"""
LOCATION_COLUMNS = f"""restaurant_id, revenue_rank, {monies("total_revenue")}, order_count, unique_customers,
  {monies("avg_order_value", digits=6)}"""
ORACLES["location_performance"] = f"WITH {LOCATIONS} SELECT {LOCATION_COLUMNS} FROM locations"
DISCOUNTS = f"""{FACTS},
split AS (SELECT is_discounted, count(*) AS orders, sum(order_gross_revenue) AS total_gross_revenue,
    sum(order_revenue) AS total_net_revenue, sum(order_discount_amount) AS total_discount FROM regular GROUP BY is_discounted),
discounts AS (SELECT CASE WHEN is_discounted THEN 'Discounted' ELSE 'Full-price' END AS segment, *,
    total_net_revenue / orders AS avg_order_value_net,
    CASE WHEN total_gross_revenue > 0 THEN -total_discount / total_gross_revenue * 100 ELSE {ZERO} END AS discount_depth_pct FROM split)"""
ORACLES["discount_effectiveness"] = f"""WITH {DISCOUNTS}
SELECT segment, is_discounted, orders, {monies("total_gross_revenue", "total_net_revenue", "total_discount")},
  {monies("avg_order_value_net", "discount_depth_pct", digits=6)} FROM discounts"""

# --- reports ---------------------------------------------------------------------
ORACLES["report_clv_kpis"] = f"""WITH {TIERS}
SELECT count(DISTINCT user_id) AS customers, {money("sum(total_clv)")} AS total_clv, {money("avg(total_clv)", 6)} AS avg_clv,
  CAST(sum(total_orders) AS BIGINT) AS orders FROM tiers"""
ORACLES["report_tier_rollup"] = f"""WITH {TIERS}
SELECT clv_tier, count(DISTINCT user_id) AS customers, {money("sum(total_clv)")} AS revenue FROM tiers GROUP BY clv_tier"""
ORACLES["report_segment_counts"] = f"WITH {RFM} SELECT rfm_segment AS segment, count(*) AS customers FROM rfm GROUP BY 1"
ORACLES["report_rfm_kpis"] = f"""WITH {RFM}
SELECT count(*) AS customers, count(*) FILTER (WHERE rfm_segment = 'VIP') AS vips,
  count(*) FILTER (WHERE rfm_segment = 'Churn Risk') AS churn_risk, {money("avg(rfm_score)", 6)} AS avg_rfm_score FROM rfm"""
ORACLES["report_rfm_sample"] = f"""WITH {RFM}
SELECT user_id, frequency, {monies("monetary")}, rfm_segment FROM rfm ORDER BY md5(concat('1', user_id)), user_id LIMIT 400"""
ORACLES["report_churn_kpis"] = f"""WITH {CHURN}
SELECT s.status, count(c.user_id) AS customers, (SELECT CAST(median(days_since_last_order) AS DOUBLE) FROM churn) AS median_days_since_order
FROM (VALUES ('Active'), ('At Risk'), ('Dormant')) AS s(status) LEFT JOIN churn c ON c.churn_status = s.status GROUP BY s.status"""
ORACLES["report_churn_histogram"] = f"""WITH {CHURN}
SELECT CAST(least(floor(days_since_last_order * 52 / CAST(365 AS DOUBLE)), 52) AS INTEGER) + 1 AS bin,
  min(days_since_last_order) AS first_days, max(days_since_last_order) AS last_days, count(*) AS customers
FROM churn GROUP BY 1"""
ORACLES["report_at_risk"] = f"""WITH {CHURN}
SELECT user_id, last_order_date, days_since_last_order, total_orders, {monies("avg_gap_days", "spend_change_pct", digits=6)}, churn_status
FROM churn WHERE at_risk"""
ORACLES["report_at_risk_total"] = f"WITH {CHURN} SELECT count(*) FILTER (WHERE at_risk) AS customers FROM churn"
ORACLES["report_monthly_revenue"] = f"""WITH {SALES}
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {money("sum(revenue)")} AS revenue FROM sales GROUP BY 1"""
ORACLES["report_sales_kpis"] = f"""WITH {SALES}
SELECT {money("sum(revenue)")} AS total_revenue, count(DISTINCT item_category) AS categories,
  count(DISTINCT restaurant_id) AS locations, count(DISTINCT order_date) AS days_covered FROM sales"""
ORACLES["report_top_categories"] = f"""WITH {SALES},
by_category AS (SELECT item_category, sum(revenue) AS r FROM sales GROUP BY item_category)
SELECT item_category, {money("r")} AS revenue FROM by_category ORDER BY r DESC, item_category LIMIT 10"""
ORACLES["report_holiday_effect"] = f"""WITH {SALES},
totals AS (SELECT order_date, is_holiday, sum(revenue) AS r FROM sales GROUP BY ALL)
SELECT CASE WHEN is_holiday THEN 'Holiday' ELSE 'Non-holiday' END AS kind, is_holiday, {money("avg(r)", 6)} AS revenue
FROM totals WHERE is_holiday IS NOT NULL GROUP BY is_holiday"""
ORACLES["report_loyalty"] = f"""WITH {LOYALTY}
SELECT s.segment, customers, {monies("avg_clv", "avg_order_value", "repeat_rate", digits=6)}
FROM (VALUES ('Loyalty'), ('Non-Loyalty')) AS s(segment) LEFT JOIN loyalty l ON l.segment = s.segment"""
ORACLES["report_location_kpis"] = f"""WITH {LOCATIONS}
SELECT count(*) AS locations, {money("max(total_revenue)")} AS top_revenue, {money("median(avg_order_value)", 6)} AS median_order_value,
  {money("sum(total_revenue)")} AS total_revenue FROM locations"""
ORACLES["report_top_locations"] = f"""WITH {LOCATIONS}
SELECT {LOCATION_COLUMNS}, substring(restaurant_id, 1, 8) AS label FROM locations ORDER BY locations.revenue_rank, restaurant_id LIMIT 15"""
ORACLES["report_discount_kpis"] = f"""WITH {DISCOUNTS}
SELECT CAST(coalesce(sum(orders) FILTER (WHERE is_discounted), 0) AS BIGINT) AS discounted_orders,
  CAST(coalesce(sum(orders) FILTER (WHERE NOT is_discounted), 0) AS BIGINT) AS full_price_orders,
  {money("-sum(total_discount)")} AS discount_given FROM discounts"""
ORACLES["report_discount_long"] = f"""WITH {DISCOUNTS}
SELECT segment, 'Gross' AS measure, {money("total_gross_revenue")} AS amount FROM discounts
UNION ALL SELECT segment, 'Net', {money("total_net_revenue")} FROM discounts"""

# --- the same results in two steps ---------------------------------------------------
for name, whole in {
    "collapse_compacted": "collapse_keyed", "collapse_compacted_multiset": "collapse_multiset",
    "line_item_facts_incremental": "line_item_facts", "order_facts_incremental": "order_facts",
    "sales_daily_incremental": "sales_daily", "clv_trends_incremental": "clv_trends",
}.items():
    ORACLES[name] = ORACLES[whole]

# --- whole pipeline ----------------------------------------------------------------
IN_YEAR = "order_date BETWEEN CAST(d - INTERVAL 12 MONTH AS DATE) AND d"
ORACLES["pipeline_marts"] = f"""WITH {FACTS},
  {dense("named", "(SELECT min(order_date) FROM named)", "(SELECT max(order_date) FROM named)")},
last AS (SELECT max(order_date) AS d FROM named),
members AS (SELECT user_id, bool_or(is_loyalty) AS m FROM named GROUP BY user_id),
totals AS (
  SELECT 'customer_clv_daily' AS mart, count(*) AS n, sum(daily_revenue) AS amount FROM clv
  UNION ALL SELECT 'clv_trends', count(DISTINCT clv_date), sum(daily_revenue) FROM clv
  UNION ALL SELECT 'customer_clv_tiers', count(DISTINCT user_id), sum(order_revenue) FROM named
  UNION ALL SELECT 'customer_rfm', count(DISTINCT user_id), count(*) FILTER (WHERE {IN_YEAR}) FROM named, last
  UNION ALL SELECT 'churn_indicators', count(DISTINCT user_id), count(*) FROM named
  UNION ALL SELECT 'sales_daily', count(DISTINCT (CAST(creation_time_utc AS DATE), restaurant_id, item_category)), sum(net_revenue)
    FROM lines WHERE net_revenue <= {ORDER_OUTLIER}
  UNION ALL SELECT 'loyalty_impact', (SELECT count(DISTINCT m) FROM members), sum(order_revenue) FROM named
  UNION ALL SELECT 'location_performance', count(DISTINCT restaurant_id), sum(order_revenue) FROM regular
  UNION ALL SELECT 'discount_effectiveness', count(DISTINCT is_discounted), sum(order_revenue) FROM regular)
SELECT mart, n, {money("amount")} AS amount, TRUE AS counted FROM totals"""

# the same results by another path
for name in ("customer_clv_tiers", "customer_rfm", "location_performance"):
    ORACLES[f"{name}_distributed"] = ORACLES[name]
