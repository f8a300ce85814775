"""The registered queries once more, as SQL for another engine.

Written from the semantics and not from the Spark plans: plain joins, COUNT(DISTINCT), windows.
Quotients are rounded in integer arithmetic, so both engines round half away from zero.
"""

from __future__ import annotations


def _title(text: str) -> str:
    parts = f"regexp_extract_all({text}, '[a-zA-Z]+|[^a-zA-Z]+')"
    return f"array_to_string(list_transform({parts}, lambda t: upper(t[1]) || lower(t[2:])), '')"


def _div(n: str, d: str, digits: int) -> str:
    """Exact n/d of two whole numbers, rounded to a decimal; NULL for d = 0."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    q = f"(sign({n}) * sign({d}) * ((2 * abs({n}) * {10**digits} + abs({d})) // (2 * abs({d}))))"
    unit = f"CAST({10.0**-digits:.{digits}f} AS DECIMAL({digits + 1},{digits}))" if digits else "1"
    return f"CASE WHEN {d} = 0 THEN NULL ELSE CAST({q} AS DECIMAL(28,0)) * {unit} END"


def _scaled(x: str, digits: int = 2) -> str:
    return f"({x}) * {10**digits}"


def _pick(number: str, *names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"([{listed}])[({number}) % {len(names)} + 1]"


def _doubles(*names: str) -> str:
    return ", ".join(f"{n}::DOUBLE AS {n}" for n in names)


def _rounded_mean(column: str, source_digits: int, digits: int) -> str:
    return _div(_scaled(f"SUM({column})", source_digits), f"COUNT({column}) * {10**source_digits}", digits)


PRELUDE = f"""
raw_customers AS (
  SELECT c_custkey AS customer_id, ' ' || upper(c_name) AS name, c_name || '@EXAMPLE.COM ' AS email,
         r_name AS region, n_name AS city, n_name AS country, c_mktsegment || ' ' AS segment,
         CASE WHEN c_custkey % 113 = 0 THEN '1993-02-31'
              ELSE strftime(DATE '1993-01-01' + CAST(c_custkey % 1461 AS INTEGER), '%Y-%m-%d') END AS joined_date,
         c_acctbal AS loyalty_score,
         CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey % 7 <> 0 AS INTEGER) END AS is_active
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
customers AS (
  SELECT customer_id, {_title("trim(name)")} AS name, lower(trim(email)) AS email,
         {_title("trim(region)")} AS region, city, country, {_title("trim(segment)")} AS segment,
         joined_date, loyalty_score, COALESCE(is_active, 1) AS is_active,
         CAST(year(joined_date) AS INTEGER) AS joined_year,
         CAST(month(joined_date) AS INTEGER) AS joined_month,
         CAST(CASE WHEN joined_date IS NOT NULL THEN greatest(date_diff('day', joined_date, DATE '2001-12-31'), 0) END AS INTEGER)
           AS tenure_days
  FROM (SELECT * REPLACE (TRY_CAST(joined_date AS DATE) AS joined_date) FROM raw_customers)),
raw_products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS sub_category,
         round(CAST(p_retailprice AS DECIMAL(18,2)) * 0.6, 2) AS unit_cost,
         CASE WHEN p_partkey % 97 = 0 THEN 0 WHEN p_partkey % 50 <> 0
              THEN CAST(p_retailprice AS DECIMAL(18,2)) * p_size END AS unit_price,
         p_size AS stock_qty, CASE WHEN p_partkey % 10 <> 0 THEN 1 END AS is_active
  FROM part),
priced AS (
  SELECT * REPLACE (CAST(COALESCE(unit_price, round(unit_cost * 1.5, 2)) AS DECIMAL(18,2)) AS unit_price)
  FROM raw_products),
products AS (
  SELECT product_id, name, {_title("trim(category)")} AS category, sub_category, unit_cost, unit_price,
         {_div("(unit_price - unit_cost) * 10000", _scaled("unit_price"), 1)} AS margin_pct, stock_qty,
         CAST(CASE WHEN unit_price <= 0 THEN 0 ELSE COALESCE(is_active, 1) END AS INTEGER) AS is_active,
         CASE WHEN unit_price <= 0 THEN NULL WHEN unit_price <= 1000 THEN 'Budget'
              WHEN unit_price <= 5000 THEN 'Mid-Range' WHEN unit_price <= 20000 THEN 'Premium'
              WHEN unit_price <= 100000 THEN 'Enterprise' ELSE 'Luxury' END AS price_band
  FROM priced),
order_lines AS (
  SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS shipped_date, COUNT(*) AS num_items
  FROM lineitem GROUP BY l_orderkey),
raw_orders AS (
  SELECT *, CASE WHEN o_orderkey % 101 = 0 THEN 'unknown' WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                 ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE WHEN o_orderstatus = 'F' THEN ' completed' WHEN o_orderstatus = 'O' AND o_orderkey % 4 = 0 THEN 'cancelled'
              WHEN o_orderstatus = 'O' THEN 'RETURNED ' WHEN o_orderkey % 2 = 0 THEN 'Pending' ELSE lower(o_orderstatus) END AS status
  FROM orders),
typed_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(TRY_CAST(order_date AS TIMESTAMP) AS DATE) AS order_date, shipped_date,
         {_title("trim(status)")} AS raw_status,
         {_title("trim(split_part(o_orderpriority, '-', 2))")} AS channel,
         {_pick("o_orderkey", "Card", "Cash", "Transfer", "Wallet", "Invoice")} AS payment_method,
         CAST(o_totalprice AS DECIMAL(18,2)) AS order_total,
         CASE WHEN o_orderkey % 9 <> 0 THEN round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.3, 2) ELSE 0 END AS order_profit,
         CAST(COALESCE(num_items, 1) AS BIGINT) AS num_items
  FROM raw_orders LEFT JOIN order_lines ON o_orderkey = l_orderkey),
clean_orders AS (
  SELECT order_id, customer_id, order_date, shipped_date,
         CASE WHEN raw_status IN ('Completed', 'Returned', 'Cancelled', 'Pending') THEN raw_status ELSE 'Unknown' END AS status,
         channel, payment_method, order_total, order_profit, num_items,
         CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
         CAST(quarter(order_date) AS INTEGER) AS order_quarter, dayname(order_date) AS order_dow,
         CAST(weekofyear(order_date) AS INTEGER) AS order_week,
         CAST(CASE WHEN shipped_date >= order_date THEN date_diff('day', order_date, shipped_date) END AS INTEGER)
           AS fulfillment_days,
         CAST(COALESCE(raw_status = 'Completed', FALSE) AS INTEGER) AS is_revenue,
         CAST(CAST(order_total AS DOUBLE) > (SELECT quantile_cont(CAST(order_total AS DOUBLE), 0.95) FROM typed_orders)
           AS INTEGER) AS is_high_value,
         CAST(order_total = 0 AS INTEGER) AS has_zero_total
  FROM typed_orders),
raw_items AS (
  SELECT l_orderkey || '-' || l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity,
         {_div(_scaled("CAST(l_extendedprice AS DECIMAL(18,2))"), "CAST(l_quantity AS INTEGER) * 100", 2)} AS unit_price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount, CAST(l_tax AS DECIMAL(4,2)) AS tax,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_amount, l_linenumber AS line_no, l_suppkey AS campaign_ref
  FROM lineitem),
all_items AS (
  SELECT item_id, order_id, product_id, greatest(quantity, 1) AS quantity, unit_price, discount * 100 AS discount_pct,
         round(unit_price * discount, 2) AS discount_amt, round(gross_amount * (1 - discount), 2) AS line_total,
         CASE WHEN line_no <> 3 THEN round(gross_amount * tax, 2) ELSE 0 END AS line_profit,
         line_no, campaign_ref, gross_amount
  FROM raw_items),
items AS (
  SELECT *, unit_price - discount_amt AS effective_unit_price FROM all_items
  QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY product_id, campaign_ref, gross_amount) = 1),
responses AS (
  SELECT CAST(props->>'$.k' AS BIGINT) AS k, COUNT(*) FILTER (event_type = 'view') AS impressions,
         COUNT(*) FILTER (event_type = 'click') AS clicks, COUNT(*) FILTER (event_type = 'purchase') AS conversions,
         SUM(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS revenue_generated
  FROM events GROUP BY 1),
raw_campaigns AS (
  SELECT s_suppkey AS campaign_id, s_name AS name,
         {_pick("s_suppkey", "Email", "Social Media", "Search Ads", "Display", "Influencer", "Event")} AS type,
         {_pick("s_suppkey", "Awareness", "Lead Gen", "Conversion", "Retention")} AS goal,
         DATE '1995-01-01' + CAST(s_suppkey % 2000 AS INTEGER) AS start_date,
         DATE '1995-01-01' + CAST(s_suppkey % 2000 + 10 + s_suppkey % 80 AS INTEGER) AS end_date,
         CAST(s_acctbal AS DECIMAL(18,2)) AS budget,
         round(greatest(CAST(s_acctbal AS DECIMAL(18,2)), 0) * 0.8, 2) AS spend,
         COALESCE(impressions, 0) AS impressions, COALESCE(clicks, 0) AS clicks, COALESCE(conversions, 0) AS conversions,
         CAST(COALESCE(revenue_generated, 0) AS DECIMAL(18,2)) AS revenue_generated,
         {_pick("s_suppkey", "Active", "Completed", "Planned")} AS status
  FROM supplier LEFT JOIN responses ON s_suppkey = k),
campaigns AS (
  SELECT *, CAST(date_diff('day', start_date, end_date) AS INTEGER) AS duration_days,
         COALESCE({_div("clicks * 100", "impressions", 3)}, 0) AS ctr,
         COALESCE({_div("conversions * 100", "clicks", 3)}, 0) AS conversion_rate,
         COALESCE({_div("(revenue_generated - spend) * 10000", _scaled("spend"), 2)}, 0) AS roi,
         {_div(_scaled("spend"), "clicks * 100", 2)} AS cost_per_click,
         {_div(_scaled("spend"), "conversions * 100", 2)} AS cost_per_conv,
         {_div(_scaled("revenue_generated"), _scaled("spend"), 2)} AS roas
  FROM raw_campaigns),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day_of_month,
         CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
         CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend, CAST(day(d) = 1 AS INTEGER) AS is_month_start,
         CAST(day(d + 1) = 1 AS INTEGER) AS is_month_end,
         CAST(day(d) = 1 AND month(d) IN (1, 4, 7, 10) AS INTEGER) AS is_quarter_start,
         CAST(day(d + 1) = 1 AND month(d) IN (3, 6, 9, 12) AS INTEGER) AS is_quarter_end,
         CAST(CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS fiscal_year,
         CAST(CASE WHEN month(d) >= 4 THEN (month(d) - 4) // 3 + 1 ELSE 4 END AS INTEGER) AS fiscal_quarter,
         strftime(d, '%Y-%m') AS year_month
  FROM (SELECT CAST(unnest(generate_series(make_date(year(min(order_date)), 1, 1), make_date(year(max(order_date)), 12, 31), INTERVAL 1 DAY))
               AS DATE) AS d FROM clean_orders)),
dim_customer AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM customers),
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key, * REPLACE (COALESCE(price_band, 'Unknown') AS price_band)
  FROM products),
dim_campaign AS (SELECT row_number() OVER (ORDER BY campaign_id) AS campaign_key, * FROM campaigns),
joined AS (
  SELECT i.*, o.channel, o.payment_method, o.status, o.is_revenue, o.order_date, d.date_key, c.customer_key, p.product_key,
         p.unit_cost
  FROM items i JOIN clean_orders o USING (order_id) JOIN dim_date d ON o.order_date = d.full_date
  JOIN dim_customer c ON o.customer_id = c.customer_id JOIN dim_product p ON i.product_id = p.product_id),
measured AS (
  SELECT j.*, c.campaign_key,
         CASE WHEN is_revenue = 1 THEN line_total ELSE 0 END AS line_revenue,
         CASE WHEN is_revenue = 1 THEN unit_cost * quantity ELSE 0 END AS line_cost,
         CASE WHEN is_revenue = 1 THEN line_total - unit_cost * quantity ELSE 0 END AS sold_profit
  FROM joined j LEFT JOIN dim_campaign c ON j.status = 'Completed' AND j.campaign_ref = c.campaign_id),
fact AS (
  SELECT date_key, customer_key, product_key, campaign_key, order_id, item_id, channel, payment_method,
         status AS order_status, quantity, unit_price, unit_cost, discount_pct, discount_amt, line_revenue, line_cost,
         sold_profit AS line_profit,
         CASE WHEN line_revenue > 0 THEN {_div("sold_profit * 10000", _scaled("line_revenue"), 1)} ELSE 0 END AS line_margin_pct,
         is_revenue
  FROM measured),
sales AS (
  SELECT f.*, d.year, d.month, d.month_name, d.year_month, d.quarter, d.full_date
  FROM fact f JOIN dim_date d USING (date_key) WHERE f.is_revenue = 1)
"""

AVG_MARGIN = _div("SUM(line_margin_pct) * 10", "COUNT(*) * 10", 1) + " AS avg_margin_pct"
AOV = _div(_scaled("SUM(line_revenue)"), "COUNT(DISTINCT order_id) * 100", 2) + " AS avg_order_value"
TOTALS = "SUM(line_revenue) AS total_revenue, SUM(line_profit) AS total_profit"
COUNTS = "COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_key) AS unique_customers"
PER_CUSTOMER = (
    _div(_scaled("SUM(line_revenue)"), "COUNT(DISTINCT customer_key) * 100", 2) + " AS revenue_per_customer"
)

MARTS = f"""
monthly_revenue AS (
  SELECT year, month, month_name, year_month, quarter, COUNT(DISTINCT order_id) AS total_orders,
         COUNT(*) AS total_line_items, {TOTALS}, {AVG_MARGIN}, COUNT(DISTINCT customer_key) AS unique_customers, {AOV}
  FROM sales GROUP BY year, month, month_name, year_month, quarter),
revenue_by_region AS (
  SELECT region, year, {COUNTS}, {TOTALS}, {AVG_MARGIN}, {AOV}
  FROM sales JOIN dim_customer USING (customer_key) GROUP BY region, year),
revenue_by_segment AS (
  SELECT segment, year, {COUNTS}, {TOTALS}, {AVG_MARGIN}, {PER_CUSTOMER}
  FROM sales JOIN dim_customer USING (customer_key) GROUP BY segment, year),
top_products AS (
  SELECT p.product_id, p.name AS product_name, p.category, p.price_band,
         CAST(SUM(quantity) AS BIGINT) AS total_units_sold, {TOTALS}, {AVG_MARGIN},
         COUNT(DISTINCT order_id) AS times_ordered, COUNT(DISTINCT customer_key) AS unique_buyers
  FROM sales JOIN dim_product p USING (product_key) GROUP BY ALL),
category_performance AS (
  SELECT category, year, COUNT(DISTINCT product_id) AS num_products, CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
         SUM(line_revenue) AS total_revenue, SUM(line_cost) AS total_cost, SUM(line_profit) AS total_profit,
         {AVG_MARGIN}, COUNT(DISTINCT order_id) AS total_orders
  FROM sales JOIN dim_product p USING (product_key) GROUP BY category, year),
campaign_sums AS (
  SELECT c.campaign_id, c.name AS campaign_name, c.type AS campaign_type, c.goal, c.budget, c.status,
         COUNT(DISTINCT order_id) AS attributed_orders, COUNT(DISTINCT customer_key) AS attributed_customers,
         SUM(line_revenue) AS attributed_revenue, SUM(line_profit) AS attributed_profit
  FROM sales JOIN dim_campaign c USING (campaign_key) GROUP BY ALL),
campaign_roi AS (
  SELECT *, round(budget, 2) AS campaign_budget,
         {_div("(attributed_revenue - budget) * 10000", _scaled("budget"), 1)} AS roi_pct FROM campaign_sums),
customer_ltv AS (
  SELECT c.customer_id, c.name, c.region, c.segment, c.joined_date, c.tenure_days, c.loyalty_score,
         COUNT(DISTINCT order_id) AS total_orders, {TOTALS}, {AOV},
         MIN(full_date) AS first_order_date, MAX(full_date) AS last_order_date,
         CASE WHEN SUM(line_revenue) > 1000000 THEN 'Platinum' WHEN SUM(line_revenue) > 600000 THEN 'Gold'
              WHEN SUM(line_revenue) > 300000 THEN 'Silver' ELSE 'Bronze' END AS ltv_tier
  FROM sales JOIN dim_customer c USING (customer_key)
  GROUP BY c.customer_id, c.name, c.region, c.segment, c.joined_date, c.tenure_days, c.loyalty_score),
first_purchase AS (SELECT customer_key, MIN(year_month) AS cohort_month FROM sales GROUP BY customer_key),
cohort_monthly AS (
  SELECT cohort_month, year_month AS activity_month, COUNT(DISTINCT customer_key) AS active_customers,
         SUM(line_revenue) AS cohort_revenue, SUM(line_profit) AS cohort_profit
  FROM sales JOIN first_purchase USING (customer_key) GROUP BY cohort_month, year_month),
channel_performance AS (
  SELECT channel, year, {COUNTS}, {TOTALS}, {AVG_MARGIN}, {AOV} FROM sales GROUP BY channel, year),
months AS (SELECT year, month, month_name, SUM(line_revenue) AS revenue FROM sales GROUP BY year, month, month_name),
yoy_comparison AS (
  SELECT a.month, a.month_name, a.revenue AS revenue_1998, b.revenue AS revenue_1999, c.revenue AS revenue_2000,
         {_div("(b.revenue - a.revenue) * 10000", _scaled("a.revenue"), 1)} AS growth_98_99_pct,
         {_div("(c.revenue - b.revenue) * 10000", _scaled("b.revenue"), 1)} AS growth_99_00_pct
  FROM months a LEFT JOIN months b ON a.month = b.month AND b.year = 1999
  LEFT JOIN months c ON a.month = c.month AND c.year = 2000 WHERE a.year = 1998),
topline AS (
  SELECT {COUNTS}, {TOTALS}, {AVG_MARGIN}, {AOV}, CAST(SUM(quantity) AS BIGINT) AS total_units,
         {_div(_scaled("SUM(line_revenue)"), "COUNT(DISTINCT order_id) * 100", 0)} AS whole_order_value
  FROM sales),
yearly AS (SELECT year, round(SUM(total_revenue), 0) AS revenue FROM monthly_revenue GROUP BY year),
growth AS (
  SELECT {_div("(revenue - before) * 100", "before", 1)} AS yoy_growth
  FROM (SELECT year, revenue, lag(revenue) OVER (ORDER BY year) AS before FROM yearly) ORDER BY year DESC LIMIT 1),
region_rollup AS (
  SELECT region, round(SUM(total_revenue), 0) AS revenue, round(SUM(total_profit), 0) AS profit,
         CAST(SUM(total_orders) AS BIGINT) AS orders, CAST(SUM(unique_customers) AS BIGINT) AS customers,
         {_rounded_mean("avg_margin_pct", 1, 1)} AS avg_margin FROM revenue_by_region GROUP BY region),
segment_rollup AS (
  SELECT segment, round(SUM(total_revenue), 0) AS revenue, round(SUM(total_profit), 0) AS profit,
         CAST(SUM(total_orders) AS BIGINT) AS orders, {_rounded_mean("avg_margin_pct", 1, 1)} AS avg_margin
  FROM revenue_by_segment GROUP BY segment),
channel_rollup AS (
  SELECT channel, round(SUM(total_revenue), 0) AS revenue, round(SUM(total_profit), 0) AS profit,
         CAST(SUM(total_orders) AS BIGINT) AS orders, {_rounded_mean("avg_margin_pct", 1, 1)} AS avg_margin,
         {_rounded_mean("avg_order_value", 2, 0)} AS avg_order_value
  FROM channel_performance GROUP BY channel),
category_rollup AS (
  SELECT category, round(SUM(total_revenue), 0) AS revenue, round(SUM(total_profit), 0) AS profit,
         round(SUM(total_cost), 0) AS cost, {_rounded_mean("avg_margin_pct", 1, 1)} AS avg_margin,
         CAST(SUM(total_units_sold) AS BIGINT) AS units, CAST(SUM(total_orders) AS BIGINT) AS orders
  FROM category_performance GROUP BY category),
ltv_tier_stats AS (
  SELECT ltv_tier, COUNT(*) AS customers, round(SUM(total_revenue), 0) AS revenue,
         {_rounded_mean("total_orders", 0, 1)} AS avg_orders, {_rounded_mean("avg_order_value", 2, 0)} AS avg_order_value
  FROM customer_ltv GROUP BY ltv_tier),
top15 AS (SELECT * FROM top_products ORDER BY total_revenue DESC, product_id LIMIT 15),
top10_customers AS (
  SELECT name, segment, region, ltv_tier, total_orders, round(total_revenue, 0)::DOUBLE AS revenue,
         round(avg_order_value, 0)::DOUBLE AS avg_order_value
  FROM customer_ltv ORDER BY total_revenue DESC, customer_id LIMIT 10),
cohort_list AS (
  SELECT cohort_month, activity_month, active_customers, round(cohort_revenue, 0) AS revenue
  FROM cohort_monthly),
shares AS (
  SELECT 'category' AS dimension, 'revenue' AS measure, category AS label, CAST(revenue AS DECIMAL(38,2)) AS value FROM category_rollup
  UNION ALL SELECT 'ltv_tier', 'revenue', ltv_tier, CAST(revenue AS DECIMAL(38,2)) FROM ltv_tier_stats
  UNION ALL SELECT 'ltv_tier', 'customers', ltv_tier, CAST(customers AS DECIMAL(38,2)) FROM ltv_tier_stats
  UNION ALL SELECT 'segment', 'revenue', segment, CAST(revenue AS DECIMAL(38,2)) FROM segment_rollup
  UNION ALL SELECT 'channel', 'revenue', channel, CAST(revenue AS DECIMAL(38,2)) FROM channel_rollup),
share_totals AS (SELECT *, SUM(value) OVER (PARTITION BY dimension, measure) AS total FROM shares)
"""

_CUSTOMER = "customer_id, name, email, region, city, country, segment, joined_date, loyalty_score, is_active, joined_year, joined_month, tenure_days"
_PRODUCT_MONEY = _doubles("unit_cost", "unit_price", "margin_pct")
_CAMPAIGN_MONEY = _doubles(
    "budget", "spend", "revenue_generated", "ctr", "conversion_rate", "roi", "cost_per_click", "cost_per_conv", "roas"
)
_CAMPAIGNS = (
    "SELECT campaign_id, name, type, goal, start_date, end_date, impressions, clicks, conversions, status, "
    f"duration_days, {_CAMPAIGN_MONEY} FROM campaigns"
)
_ITEM_MONEY = _doubles("unit_price", "discount_pct", "discount_amt", "line_total", "line_profit", "gross_amount")
_ITEMS = (
    f"SELECT item_id, order_id, product_id, quantity, {_ITEM_MONEY}, effective_unit_price::DOUBLE AS effective_unit_price, "
    "line_no, campaign_ref FROM items"
)
_COMPACT = """
CASE WHEN amount >= 10000000 THEN '₹' || CAST(round(CAST(amount AS DECIMAL(38,3)) / 10000000, 1) AS DECIMAL(20,1)) || ' Cr'
     WHEN amount >= 100000 THEN '₹' || CAST(round(CAST(amount AS DECIMAL(38,3)) / 100000, 1) AS DECIMAL(20,1)) || 'L'
     ELSE '₹' || format('{:,}', CAST(amount AS BIGINT)) END
"""
_LABELLED = """
  SELECT 'total_revenue' AS label, round(total_revenue, 0) AS amount FROM topline
  UNION ALL SELECT 'total_profit', round(total_profit, 0) FROM topline
  UNION ALL SELECT 'avg_order_value', round(whole_order_value, 0) FROM topline
  UNION ALL SELECT region, revenue FROM region_rollup
"""


def _nulls(source: str, name: str, *columns: str) -> str:
    parts = [
        f"SELECT '{name}' AS dataset, '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS nulls, COUNT(*) AS n FROM {source}"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


def _count_rows(label: str, names: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS \"{label}\", COUNT(*) AS rows FROM {t}" for k, t in names.items())


def _violations(dataset: str, source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS rule, COUNT(*) FILTER (NOT COALESCE({rule}, FALSE)) AS violations FROM {source}"
        for name, rule in rules.items()
    )


def _orphans(label: str, child: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{label}' AS \"check\", COUNT(*) AS orphans FROM {child} c LEFT JOIN {parent} p USING ({key}) "
        f"WHERE p.{key} IS NULL"
    )


_SOLD = "(SELECT * FROM clean_orders WHERE is_revenue = 1 AND order_date IS NOT NULL AND order_id IN (SELECT order_id FROM items))"


STAGED = {
    "stg_customers": "customers", "stg_products": "products", "stg_orders": "clean_orders",
    "stg_order_items": "items", "stg_campaigns": "campaigns",
}
COLUMNS = {
    "stg_customers": ("customers", _CUSTOMER.split(", ")),
    "stg_products": (
        "products",
        "product_id, name, category, sub_category, unit_cost, unit_price, margin_pct, stock_qty, is_active, price_band".split(", "),
    ),
    "stg_orders": (
        "clean_orders",
        (
            "order_id, customer_id, order_date, shipped_date, status, channel, payment_method, order_total, order_profit, "
            "num_items, order_year, order_month, order_quarter, order_dow, order_week, fulfillment_days, is_revenue, "
            "is_high_value, has_zero_total"
        ).split(", "),
    ),
    "stg_order_items": (
        "items",
        (
            "item_id, order_id, product_id, quantity, unit_price, discount_pct, discount_amt, line_total, line_profit, "
            "line_no, campaign_ref, gross_amount, effective_unit_price"
        ).split(", "),
    ),
    "stg_campaigns": (
        "campaigns",
        (
            "campaign_id, name, type, goal, start_date, end_date, budget, spend, impressions, clicks, conversions, "
            "revenue_generated, status, ctr, conversion_rate, roi, duration_days, cost_per_click, cost_per_conv, roas"
        ).split(", "),
    ),
}
CONTRACT = {
    "customers": ("raw_customers", "customer_id name email region segment joined_date", "city country loyalty_score is_active"),
    "products": (
        "raw_products", "product_id name category unit_cost unit_price", "sub_category margin_pct stock_qty is_active",
    ),
    "orders": (
        "typed_orders", "order_id customer_id order_date status order_total",
        "shipped_date channel payment_method order_profit num_items",
    ),
    "order_items": (
        "raw_items", "item_id order_id product_id quantity unit_price line_total",
        "discount_pct discount_amt line_profit line_no campaign_ref gross_amount",
    ),
    "campaigns": (
        "raw_campaigns", "campaign_id name type start_date end_date spend impressions",
        "goal budget clicks conversions revenue_generated status ctr conversion_rate roi",
    ),
}


def _contract() -> str:
    parts = []
    for source, (table, required, additional) in CONTRACT.items():
        listed = [(c, "present") for c in required.split()] + [(c, "additional") for c in additional.split()]
        values = ", ".join(f"('{c}', '{s}')" for c, s in listed)
        parts.append(
            f"SELECT '{source}' AS source, v.\"column\", v.status, (SELECT COUNT(*) FROM {table}) AS rows "
            f"FROM (VALUES {values}) v(\"column\", status)"
        )
    return " UNION ALL ".join(parts)


def _quality() -> str:
    parts = []
    for name, (table, columns) in COLUMNS.items():
        nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in columns)
        parts.append(
            f"SELECT '{name}' AS dataset, COUNT(*) AS rows, CAST(SUM({nulls}) AS BIGINT) AS nulls, "
            f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {table})) AS duplicates, "
            f"{len(columns)} AS width FROM {table}"
        )
    counted = " UNION ALL ".join(parts)
    return (
        f"SELECT dataset, rows, {_div('nulls * 100', 'rows * width', 1)}::DOUBLE AS null_pct, duplicates, "
        "CASE WHEN nulls * 100 < 5 * rows * width AND duplicates = 0 THEN 'PASS' ELSE 'CHECK' END AS status "
        f"FROM ({counted}) UNION ALL SELECT 'TOTAL', CAST(SUM(rows) AS BIGINT), NULL, NULL, NULL FROM ({counted})"
    )


def _null_report() -> str:
    parts = " UNION ALL ".join(_nulls(table, name, *columns) for name, (table, columns) in COLUMNS.items())
    pct = _div("nulls * 100", "n", 1)
    return f'SELECT dataset, "column", nulls, ({pct})::DOUBLE AS null_pct FROM ({parts}) WHERE nulls > 0'


def _matrix() -> str:
    """Columns are the first 24 months of the data: 1995 has orders from its first month on at every scale."""
    months = [f"{y}-{m:02d}" for y in (1995, 1996) for m in range(1, 13)]
    cells = ", ".join(f"MAX(revenue) FILTER (activity_month = '{m}')::DOUBLE AS \"{m}\"" for m in months)
    first = "SELECT DISTINCT cohort_month FROM cohort_list ORDER BY 1 LIMIT 12"
    return f"SELECT cohort_month, {cells} FROM cohort_list WHERE cohort_month IN ({first}) GROUP BY cohort_month"


def _long(source: str, entity: str, *measures: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{entity}' AS dimension, {entity} AS entity, '{m}' AS metric, {m}::DOUBLE AS value FROM {source}"
        for m in measures
    )


_ORDERED_ROLLUP = "round(SUM(total_revenue), 0)::DOUBLE AS revenue, CAST(SUM(total_orders) AS BIGINT) AS orders"
_REJECTED = """
SELECT i.item_id, i.order_id, i.product_id, CAST(o.order_id IS NULL AS INTEGER) AS missing_order,
       CAST(o.order_id IS NOT NULL AND d.date_key IS NULL AS INTEGER) AS missing_date,
       CAST(o.order_id IS NOT NULL AND c.customer_key IS NULL AS INTEGER) AS missing_customer,
       CAST(p.product_key IS NULL AS INTEGER) AS missing_product,
       CAST(COALESCE(greatest(abs(i.unit_price), abs(i.discount_pct), abs(i.discount_amt), abs(i.line_total), abs(p.unit_cost)) >= 1e16
         OR p.unit_cost * i.quantity >= 1e16 OR i.quantity IS NULL, FALSE) AS INTEGER) AS unusable_value
FROM items i LEFT JOIN clean_orders o USING (order_id)
LEFT JOIN dim_date d ON o.order_date = d.full_date
LEFT JOIN dim_customer c ON o.customer_id = c.customer_id LEFT JOIN dim_product p ON i.product_id = p.product_id
WHERE o.order_id IS NULL OR d.date_key IS NULL OR c.customer_key IS NULL OR p.product_key IS NULL OR unusable_value = 1
"""
_WAREHOUSE = {
    "dim_date": "dim_date", "dim_customer": "dim_customer", "dim_product": "dim_product",
    "dim_campaign": "dim_campaign", "fact_sales": "fact",
}

FINAL = {
    # marts
    "monthly_revenue": f"SELECT * REPLACE ({_doubles('total_revenue', 'total_profit', 'avg_margin_pct', 'avg_order_value')}) FROM monthly_revenue",
    "revenue_by_region": f"SELECT * REPLACE ({_doubles('total_revenue', 'total_profit', 'avg_margin_pct', 'avg_order_value')}) FROM revenue_by_region",
    "revenue_by_segment": f"SELECT * REPLACE ({_doubles('total_revenue', 'total_profit', 'avg_margin_pct', 'revenue_per_customer')}) FROM revenue_by_segment",
    "top_products": f"SELECT * REPLACE ({_doubles('total_revenue', 'total_profit', 'avg_margin_pct')}) FROM top_products",
    "category_performance": f"SELECT * REPLACE ({_doubles('total_revenue', 'total_cost', 'total_profit', 'avg_margin_pct')}) FROM category_performance",
    "campaign_roi": f"SELECT * REPLACE ({_doubles('budget', 'attributed_revenue', 'attributed_profit', 'campaign_budget', 'roi_pct')}) FROM campaign_roi",
    "customer_ltv": f"SELECT * REPLACE ({_doubles('total_revenue', 'total_profit', 'avg_order_value')}) FROM customer_ltv",
    "cohort_monthly": f"SELECT * REPLACE ({_doubles('cohort_revenue', 'cohort_profit')}) FROM cohort_monthly",
    "channel_performance": f"SELECT * REPLACE ({_doubles('total_revenue', 'total_profit', 'avg_margin_pct', 'avg_order_value')}) FROM channel_performance",
    "yoy_comparison": f"SELECT month, month_name, {_doubles('revenue_1998', 'revenue_1999', 'revenue_2000', 'growth_98_99_pct', 'growth_99_00_pct')} FROM yoy_comparison",
    # reports
    "report_topline": f"SELECT total_orders, unique_customers, {_doubles('total_revenue', 'total_profit', 'avg_margin_pct', 'avg_order_value')} FROM topline",
    "report_by_year": f"SELECT year, {_ORDERED_ROLLUP} FROM monthly_revenue GROUP BY year",
    "report_by_region": f"SELECT region, {_ORDERED_ROLLUP} FROM revenue_by_region GROUP BY region",
    "report_by_segment": f"SELECT segment, {_ORDERED_ROLLUP} FROM revenue_by_segment GROUP BY segment",
    "report_by_channel": f"SELECT channel, {_ORDERED_ROLLUP} FROM channel_performance GROUP BY channel",
    "report_by_category": "SELECT category, revenue::DOUBLE AS revenue, avg_margin::DOUBLE AS avg_margin FROM category_rollup",
    "report_top5_products": (
        f"SELECT product_name, category, {_doubles('total_revenue', 'avg_margin_pct')}, total_units_sold "
        "FROM (SELECT * FROM top_products ORDER BY total_revenue DESC, product_id LIMIT 5)"
    ),
    "report_top5_campaigns": (
        f"SELECT campaign_name, campaign_type, {_doubles('attributed_revenue', 'roi_pct')} "
        "FROM (SELECT * FROM campaign_roi ORDER BY attributed_revenue DESC, campaign_id LIMIT 5)"
    ),
    "report_ltv_tiers": "SELECT ltv_tier, customers, revenue::DOUBLE AS total_revenue FROM ltv_tier_stats",
    "kpi_cards": (
        "SELECT round(total_revenue, 0)::DOUBLE AS total_revenue, round(total_profit, 0)::DOUBLE AS total_profit, "
        "total_orders, unique_customers, avg_margin_pct::DOUBLE AS avg_margin, "
        "whole_order_value::DOUBLE AS avg_order_value, total_units, "
        "(SELECT yoy_growth FROM growth)::DOUBLE AS yoy_growth FROM topline"
    ),
    "monthly_trend": (
        "SELECT year_month, year, month_name, month, round(total_revenue, 0)::DOUBLE AS revenue, "
        "round(total_profit, 0)::DOUBLE AS profit, total_orders, avg_margin_pct::DOUBLE AS margin, unique_customers, "
        "round(avg_order_value, 0)::DOUBLE AS aov FROM monthly_revenue"
    ),
    "yoy_table": (
        "SELECT month, month_name, round(revenue_1998, 0)::DOUBLE AS revenue_1998, "
        "round(revenue_1999, 0)::DOUBLE AS revenue_1999, round(revenue_2000, 0)::DOUBLE AS revenue_2000, "
        f"{_doubles('growth_98_99_pct', 'growth_99_00_pct')} FROM yoy_comparison"
    ),
    "region_rollup": f"SELECT region, orders, customers, {_doubles('revenue', 'profit', 'avg_margin')} FROM region_rollup",
    "segment_rollup": f"SELECT segment, orders, {_doubles('revenue', 'profit', 'avg_margin')} FROM segment_rollup",
    "channel_rollup": f"SELECT channel, orders, {_doubles('revenue', 'profit', 'avg_margin', 'avg_order_value')} FROM channel_rollup",
    "category_rollup": f"SELECT category, units, orders, {_doubles('revenue', 'profit', 'cost', 'avg_margin')} FROM category_rollup",
    "top15_products": (
        "SELECT product_name, category, price_band, round(total_revenue, 0)::DOUBLE AS revenue, "
        "round(total_profit, 0)::DOUBLE AS profit, avg_margin_pct::DOUBLE AS margin, total_units_sold AS units, "
        "times_ordered, unique_buyers FROM top15"
    ),
    "campaign_list": (
        "SELECT campaign_name, campaign_type, goal, round(campaign_budget, 0)::DOUBLE AS budget, "
        "round(attributed_revenue, 0)::DOUBLE AS revenue, round(attributed_profit, 0)::DOUBLE AS profit, "
        "roi_pct::DOUBLE AS roi_pct, attributed_orders AS orders, attributed_customers AS customers FROM campaign_roi"
    ),
    "ltv_tier_stats": f"SELECT ltv_tier, customers, {_doubles('revenue', 'avg_orders', 'avg_order_value')} FROM ltv_tier_stats",
    "top10_customers": "SELECT * FROM top10_customers",
    "top10_customers_ascending": "SELECT * FROM top10_customers ORDER BY revenue",
    "cohort_list": "SELECT cohort_month, activity_month, active_customers, revenue::DOUBLE AS revenue FROM cohort_list",
    # chart data
    "cohort_matrix": _matrix(),
    "roi_by_type": (
        f"SELECT campaign_type, ({_div('SUM(COALESCE(roi_pct, 0)) * 10', 'COUNT(*) * 10', 1)})::DOUBLE AS avg_roi "
        "FROM campaign_roi GROUP BY campaign_type"
    ),
    "revenue_share": (
        "SELECT dimension, measure, label, value::DOUBLE AS value, "
        f"({_div('value * 10000', 'total * 100', 1)})::DOUBLE AS pct FROM share_totals"
    ),
    "compact_money": (
        f"SELECT label, amount::DOUBLE AS amount, {_COMPACT} AS display, "
        f"replace(replace({_COMPACT}, '₹', ''), ' Cr', 'Cr') AS display_short FROM ({_LABELLED})"
    ),
    "product_bubbles": (
        "SELECT product_name, split_part(product_name, ' ', 1) || ' ' || split_part(product_name, ' ', 2) AS label, "
        "category, round(total_revenue, 0)::DOUBLE AS revenue, avg_margin_pct::DOUBLE AS margin, "
        "greatest(8.0::DOUBLE, sqrt(total_units_sold::DOUBLE) * 1.5::DOUBLE) AS bubble_size FROM top15"
    ),
    "campaigns_by_type": (
        "SELECT campaign_type, campaign_name, round(campaign_budget, 0)::DOUBLE AS budget, "
        "round(attributed_revenue, 0)::DOUBLE AS revenue FROM campaign_roi"
    ),
    "cost_profit_long": " UNION ALL ".join(
        [
            _long("category_rollup", "category", "cost", "profit"),
            _long("region_rollup", "region", "revenue", "profit"),
            _long("channel_rollup", "channel", "revenue", "profit"),
        ]
    ),
    # cleaning
    "clean_customers": f"SELECT {_CUSTOMER} FROM customers",
    "clean_products": f"SELECT product_id, name, category, sub_category, stock_qty, is_active, price_band, {_PRODUCT_MONEY} FROM products",
    "clean_orders": f"SELECT * REPLACE ({_doubles('order_total', 'order_profit')}) FROM clean_orders",
    "clean_order_items": _ITEMS,
    "clean_campaigns": _CAMPAIGNS,
    "dedup_items": "SELECT COUNT(*) AS rows, COUNT(DISTINCT item_id) AS kept, COUNT(*) - COUNT(DISTINCT item_id) AS removed FROM raw_items",
    "price_bands": "SELECT COALESCE(price_band, 'Unknown') AS price_band, COUNT(*) AS rows FROM products GROUP BY 1",
    "high_value_orders": f"SELECT order_id, customer_id, order_date, {_doubles('order_total')} FROM clean_orders WHERE is_high_value = 1",
    "line_economics": (
        "SELECT item_id, " + _doubles("discount_amt", "line_total", "line_profit") + " FROM ("
        "SELECT item_id, round(i.unit_price * discount_pct * 0.01, 2) AS discount_amt, "
        "(i.unit_price - round(i.unit_price * discount_pct * 0.01, 2)) * quantity AS line_total, "
        "(i.unit_price - round(i.unit_price * discount_pct * 0.01, 2) - p.unit_cost) * quantity AS line_profit "
        "FROM (SELECT * REPLACE (CAST(discount_pct AS INTEGER) AS discount_pct) FROM items) i JOIN products p USING (product_id))"
    ),
    "order_rollup": (
        "SELECT order_id, status, (CASE WHEN status IN ('Cancelled', 'Returned') THEN 0 ELSE COALESCE(t, 0) END)::DOUBLE AS order_total, "
        "(CASE WHEN status IN ('Cancelled', 'Returned') THEN 0 ELSE COALESCE(p, 0) END)::DOUBLE AS order_profit, "
        "COALESCE(n, 0) AS num_items FROM clean_orders LEFT JOIN "
        "(SELECT order_id, SUM(line_total) AS t, SUM(line_profit) AS p, COUNT(*) AS n FROM items GROUP BY order_id) USING (order_id)"
    ),
    "order_total_quantiles": " UNION ALL ".join(
        f"SELECT {q}::DOUBLE AS level, round(quantile_cont(order_total::DOUBLE, {q}), 4) AS order_total FROM clean_orders"
        for q in (0.05, 0.5, 0.95)
    ),
    "orders_summary": (
        "SELECT COUNT(*) AS orders, COUNT(*) FILTER (status = 'Completed') AS completed_orders, "
        "(SUM(order_total) FILTER (status = 'Completed'))::DOUBLE AS completed_total FROM clean_orders"
    ),
    # warehouse
    "dim_date": "SELECT * FROM dim_date",
    "dim_customer": (
        "SELECT customer_key, customer_id, name, email, region, city, country, segment, joined_date, joined_year, "
        "tenure_days, loyalty_score, is_active FROM dim_customer"
    ),
    "dim_product": (
        "SELECT product_key, product_id, name, category, sub_category, price_band, is_active, "
        f"{_PRODUCT_MONEY} FROM dim_product"
    ),
    "dim_campaign": (
        "SELECT campaign_key, campaign_id, name, type, goal, start_date, end_date, duration_days, "
        "budget::DOUBLE AS budget, status FROM dim_campaign"
    ),
    "fact_sales": (
        "SELECT * REPLACE ("
        + _doubles(
            "unit_price", "unit_cost", "discount_pct", "discount_amt", "line_revenue", "line_cost", "line_profit",
            "line_margin_pct",
        )
        + ") FROM fact"
    ),
    "order_sales": (
        "SELECT order_id, customer_key, date_key, channel, COUNT(*) AS line_items, CAST(SUM(quantity) AS BIGINT) AS units, "
        "SUM(line_revenue)::DOUBLE AS revenue, SUM(line_profit)::DOUBLE AS profit, SUM(line_margin_pct)::DOUBLE AS margin_sum "
        "FROM fact WHERE is_revenue = 1 GROUP BY ALL"
    ),
    "lines_of_day": (
        "SELECT date_key, day_name, is_weekend, order_id, item_id, product_key, customer_key, is_revenue, line_revenue::DOUBLE AS line_revenue, "
        "line_profit::DOUBLE AS line_profit FROM fact JOIN dim_date USING (date_key) WHERE full_date = DATE '1997-06-16'"
    ),
    "fact_rejects": _REJECTED,
    "reject_summary": " UNION ALL ".join(
        f"SELECT '{r}' AS reason, CAST(COALESCE(SUM({r}), 0) AS BIGINT) AS rows FROM ({_REJECTED})"
        for r in ("missing_order", "missing_date", "missing_customer", "missing_product", "unusable_value")
    ),
    "fact_summary": (
        "SELECT COUNT(*) AS fact_rows, COUNT(*) FILTER (is_revenue = 1) AS revenue_rows, SUM(line_revenue)::DOUBLE AS total_revenue, "
        f"SUM(line_profit)::DOUBLE AS total_profit, ({_div('SUM(line_profit) * 10000', _scaled('SUM(line_revenue)'), 1)})::DOUBLE "
        "AS weighted_margin_pct FROM fact"
    ),
    "warehouse_counts": (
        'SELECT CASE WHEN "table" IS NULL THEN \'TOTAL\' WHEN "table" LIKE \'fact%\' THEN \'FACT\' ELSE \'DIM\' END AS kind, '
        f'COALESCE("table", \'TOTAL\') AS "table", CAST(SUM(rows) AS BIGINT) AS rows FROM ({_count_rows("table", _WAREHOUSE)}) '
        'GROUP BY ROLLUP ("table")'
    ),
    "campaign_attribution": "SELECT item_id, campaign_key FROM fact WHERE campaign_key IS NOT NULL",
    # quality
    "null_report": _null_report(),
    "quality_report": _quality(),
    "date_parse_report": " UNION ALL ".join(
        f"SELECT '{s}' AS source, '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL) AS unreadable, "
        f"COUNT(*) FILTER ({c} IS NULL) AS missing, COUNT(*) FILTER (TRY_CAST({c} AS TIMESTAMP) IS NULL) AS null_dates FROM {t}"
        for s, t, c in (
            ("orders", "raw_orders", "order_date"), ("orders", "typed_orders", "shipped_date"),
            ("customers", "raw_customers", "joined_date"),
            ("campaigns", "raw_campaigns", "start_date"), ("campaigns", "raw_campaigns", "end_date"),
        )
    ),
    "orphan_checks": (
        "SELECT \"check\", orphans, CASE WHEN orphans = 0 THEN 'OK' ELSE orphans || ' orphans' END AS status FROM ("
        + " UNION ALL ".join(
            [
                _orphans("orders -> customers", "clean_orders", "customers", "customer_id"),
                _orphans("order_items -> orders", "items", "clean_orders", "order_id"),
                _orphans("order_items -> products", "items", "products", "product_id"),
                _orphans("fact -> dim_date", "fact", "dim_date", "date_key"),
                _orphans("fact -> dim_customer", "fact", "dim_customer", "customer_key"),
                _orphans("fact -> dim_product", "fact", "dim_product", "product_key"),
                _orphans(
                    "order_items -> revenue orders", "items",
                    "(SELECT order_id FROM clean_orders WHERE is_revenue = 1)", "order_id",
                ),
            ]
        )
        + ")"
    ),
    "duplicate_keys": "SELECT item_id, COUNT(*) AS copies FROM raw_items GROUP BY item_id HAVING COUNT(*) > 1",
    "missing_keys": " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS nulls FROM {t}"
        for n, t, c in (
            ("fact_sales", "fact", "date_key"), ("fact_sales", "fact", "customer_key"),
            ("fact_sales", "fact", "product_key"), ("fact_sales", "fact", "campaign_key"),
            ("dim_customer", "dim_customer", "customer_id"),
        )
    ),
    "accepted_values": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS rows FROM {t} WHERE COALESCE({c} NOT IN ({v}), TRUE) GROUP BY {c}"
        for c, t, v in (
            ("status", "clean_orders", "'Completed', 'Returned', 'Cancelled', 'Pending'"),
            ("segment", "dim_customer", "'Enterprise', 'Smb', 'Startup', 'Consumer'"),
            ("region", "dim_customer", "'North', 'South', 'East', 'West', 'Central'"),
            ("channel", "clean_orders", "'Online', 'Sales Rep', 'Partner', 'Direct'"),
            ("ltv_tier", "customer_ltv", "'Platinum', 'Gold', 'Silver', 'Bronze'"),
        )
    ),
    "range_rules": " UNION ALL ".join(
        [
            _violations("dim_product", "dim_product", {"price_positive": "unit_price > 0", "price_above_cost": "unit_price > unit_cost"}),
            _violations(
                "fact_sales", "fact",
                {
                    "revenue_line_positive": "is_revenue = 0 OR line_revenue > 0",
                    "other_line_zero": "is_revenue = 1 OR line_revenue = 0",
                    "profit_not_negative": "line_profit >= 0",
                },
            ),
            _violations("monthly_revenue", "monthly_revenue", {"revenue_not_negative": "total_revenue >= 0"}),
        ]
    ),
    "profit_identity": (
        "SELECT COUNT(*) AS checked, COUNT(*) FILTER (abs(round(line_profit, 1) - round(line_revenue - line_cost, 1)) >= 1) "
        "AS breaks FROM fact WHERE is_revenue = 1"
    ),
    "expected_rows": " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", (SELECT COUNT(*) FROM {table}) AS rows, CAST(({wanted}) AS BIGINT) AS expected, "
        f"(SELECT COUNT(*) FROM {table}) = ({wanted}) AS holds"
        for name, table, wanted in (
            ("calendar days", "dim_date", "SELECT date_diff('day', MIN(full_date), MAX(full_date)) + 1 FROM dim_date"),
            ("months with revenue", "monthly_revenue", f"SELECT COUNT(DISTINCT strftime(order_date, '%Y-%m')) FROM {_SOLD}"),
            (
                "months compared", "yoy_comparison",
                f"SELECT COUNT(DISTINCT month(order_date)) FROM {_SOLD} WHERE year(order_date) = 1998",
            ),
            ("channels", "channel_rollup", f"SELECT COUNT(DISTINCT channel) FROM {_SOLD}"),
            ("channels by year", "channel_performance", f"SELECT COUNT(DISTINCT (channel, year(order_date))) FROM {_SOLD}"),
            ("products sold", "top_products", "SELECT COUNT(DISTINCT product_key) FROM sales"),
            ("customers who bought", "customer_ltv", "SELECT COUNT(DISTINCT customer_key) FROM sales"),
            ("campaigns", "campaign_roi", "SELECT COUNT(DISTINCT campaign_key) FROM sales"),
            ("orders sold", "(SELECT DISTINCT order_id FROM sales)", "SELECT COUNT(DISTINCT order_id) FROM sales"),
        )
    ),
    "sorted_products": " UNION ALL ".join(
        f"SELECT '{m}' AS measure, COUNT(*) FILTER (v > before) AS inversions, COUNT(*) AS rows FROM "
        f"(SELECT {m} AS v, lag({m}) OVER (ORDER BY total_revenue DESC, product_id) AS before FROM top_products)"
        for m in ("total_revenue", "total_units_sold")
    ),
    "order_date_range": "SELECT MIN(order_date) AS first, MAX(order_date) AS last FROM clean_orders",
    "headline_sanity": _violations(
        "kpi_cards", "topline",
        {
            "revenue_positive": "total_revenue > 0", "profit_below_revenue": "total_profit < total_revenue",
            "margin_between_0_and_100": "avg_margin_pct > 0 AND avg_margin_pct < 100", "orders_positive": "total_orders > 0",
            "customers_positive": "unique_customers > 0", "units_positive": "total_units > 0",
        },
    ),
    "more_items_than_orders": (
        "SELECT (SELECT COUNT(*) FROM items) AS rows, (SELECT COUNT(*) FROM clean_orders) AS other_rows, "
        "(SELECT COUNT(*) FROM items) > (SELECT COUNT(*) FROM clean_orders) AS holds"
    ),
    "orders_without_items": "SELECT order_id FROM clean_orders EXCEPT SELECT order_id FROM items",
    "status_counts": "SELECT status, COUNT(*) AS rows FROM clean_orders GROUP BY status",
    "distinct_segments": "SELECT DISTINCT segment FROM dim_customer",
    # reading and writing
    "csv_roundtrip": f"SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id) FROM (SELECT {_CUSTOMER} FROM customers)",
    "json_records_roundtrip": _CAMPAIGNS,
    "json_array_roundtrip": _CAMPAIGNS,
    "campaigns_from_text": (
        "SELECT campaign_id, impressions, clicks, conversions, (spend + 0.004)::DOUBLE AS spend, "
        "(CASE WHEN campaign_id % 7 = 0 THEN 12345678901234567890.5 WHEN campaign_id % 11 <> 0 THEN 7.125 ELSE 0 END)::DOUBLE AS budget, "
        f"({_div('CAST((spend + 0.004) * 1000 AS BIGINT)', 'clicks * 1000', 2)})::DOUBLE AS cost_per_click FROM campaigns"
    ),
    "items_from_text": (
        "SELECT item_id, CASE WHEN part % 11 = 3 THEN 3000000000 WHEN part % 11 <> 4 THEN greatest(CASE WHEN part % 11 = 5 THEN 0 ELSE quantity END, 1) END AS quantity, "
        "CASE part % 11 WHEN 6 THEN NULL WHEN 7 THEN 0 ELSE line_total END::DOUBLE AS line_total, "
        "CASE part % 11 WHEN 8 THEN NULL ELSE line_profit END::DOUBLE AS line_profit "
        "FROM (SELECT *, CAST(order_id AS BIGINT) AS part FROM items)"
    ),
    "value_rejects": (
        "SELECT 'order_items' AS source, l_orderkey || '-' || l_linenumber AS key, \"column\", raw_text, reason FROM lineitem "
        "JOIN (VALUES (4, 'quantity', '123456789012345678901', 'out of range'), (5, 'quantity', 'two', 'unreadable'), "
        "(6, 'line_total', 'Infinity', 'out of range'), (7, 'line_total', 'x1', 'unreadable'), "
        "(8, 'line_profit', '123456789012345678901234567890', 'out of range')) AS bad(part, \"column\", raw_text, reason) ON l_orderkey % 11 = part UNION ALL "
        "SELECT 'customers', CAST(customer_id AS VARCHAR), 'joined_date', joined_date, 'unreadable' FROM raw_customers WHERE joined_date = '1993-02-31' UNION ALL "
        "SELECT 'orders', CAST(o_orderkey AS VARCHAR), 'order_date', 'unknown', 'unreadable' FROM orders WHERE o_orderkey % 101 = 0"
    ),
    "extract_report": (
        "SELECT 'customers' AS source, 'read' AS status, 'missing columns: email' AS missing, COUNT(*) AS rows FROM raw_customers "
        "UNION ALL SELECT s, 'failed', '', NULL FROM (VALUES ('products'), ('orders'), ('order_items'), ('campaigns')) AS v(s)"
    ),
    "json_contract": (
        "SELECT 'campaigns' AS source, c AS \"column\", s AS status FROM (VALUES ('campaign_id', 'present'), ('name', 'present'), "
        "('type', 'present'), ('start_date', 'present'), ('end_date', 'present'), ('spend', 'missing'), ('impressions', 'present'), "
        "('extra_col', 'additional')) AS v(c, s) WHERE EXISTS (SELECT 1 FROM raw_campaigns)"
    ),
    "tables_present": (
        "SELECT name, name <> 'vw_unknown' AS present, CASE WHEN name <> 'vw_unknown' THEN CAST(0 AS BIGINT) END AS missing_columns "
        "FROM (SELECT 'vw_' || unnest(['monthly_revenue', 'revenue_by_region', 'revenue_by_segment', 'top_products', "
        "'category_performance', 'campaign_roi', 'customer_ltv', 'cohort_monthly', 'channel_performance', 'yoy_comparison', "
        "'unknown']) AS name)"
    ),
    "json_records": f"SELECT * REPLACE ({_doubles('total_revenue', 'total_profit', 'avg_margin_pct', 'avg_order_value')}) FROM channel_performance",
    "staging_load_counts": _count_rows("table", STAGED),
    "mart_csv_export": " UNION ALL ".join(
        f"SELECT '{m}' AS mart, COUNT(*) AS rows, CAST(SUM(CAST('0x' || substr(md5(concat_ws('|', {keys})), 1, 8) AS BIGINT)) AS BIGINT) AS keys_digest, "
        f"CAST(SUM(CAST({measure} AS DECIMAL(28,2))) AS DOUBLE) AS measure_sum FROM {m}"
        for m, keys, measure in (
            ("monthly_revenue", "year_month", "total_revenue"), ("revenue_by_region", "region, year", "total_revenue"),
            ("revenue_by_segment", "segment, year", "total_revenue"), ("top_products", "product_id", "total_revenue"),
            ("category_performance", "category, year", "total_revenue"), ("campaign_roi", "campaign_id", "attributed_revenue"),
            ("customer_ltv", "customer_id", "total_revenue"), ("cohort_monthly", "cohort_month, activity_month", "cohort_revenue"),
            ("channel_performance", "channel, year", "total_revenue"), ("yoy_comparison", "month, month_name", "revenue_1999"),
        )
    ),
    "column_contract": _contract(),
    "scan_profile": " UNION ALL ".join(
        f"SELECT '{t}' AS source, COUNT(*) AS rows, CAST({width} AS INTEGER) AS columns, CAST(1 AS BIGINT) AS files, "
        f"COUNT(*) > 0 AS has_bytes FROM {t}"
        for t, width in (("customer", 5), ("part", 6), ("orders", 6), ("lineitem", 11), ("supplier", 4), ("events", 6))
    ),
    "mart_views_sql": (
        "SELECT r.year, COUNT(*) AS regions, SUM(r.total_revenue)::DOUBLE AS revenue, MAX(m.months) AS months "
        "FROM revenue_by_region r JOIN (SELECT year, COUNT(*) AS months FROM monthly_revenue GROUP BY year) m USING (year) "
        "GROUP BY r.year"
    ),
}

FINAL["pipeline_reports"] = " UNION ALL ".join(
    f"SELECT '{report}' AS report, CAST({label} AS VARCHAR) AS label, CAST({value} AS DOUBLE) AS value FROM ({sql})"
    for report, label, value, sql in (
        ("report_by_region", "region", "revenue", FINAL["report_by_region"]),
        ("report_by_year", "year", "revenue", FINAL["report_by_year"]),
        ("report_ltv_tiers", "ltv_tier", "customers", FINAL["report_ltv_tiers"]),
        ("rejects", "reason", "rows", FINAL["reject_summary"]),
        ("staging_counts", '"table"', "rows", FINAL["staging_load_counts"]),
        ("warehouse", '"table"', "rows", FINAL["warehouse_counts"]),
    )
)


# Dates leave the queries as text.
DATES = {
    "customer_ltv": ("joined_date", "first_order_date", "last_order_date"),
    "clean_customers": ("joined_date",),
    "csv_roundtrip": ("joined_date",),
    "clean_orders": ("order_date", "shipped_date"),
    "clean_campaigns": ("start_date", "end_date"),
    "json_records_roundtrip": ("start_date", "end_date"),
    "json_array_roundtrip": ("start_date", "end_date"),
    "high_value_orders": ("order_date",),
    "dim_date": ("full_date",),
    "dim_customer": ("joined_date",),
    "dim_campaign": ("start_date", "end_date"),
    "order_date_range": ("first", "last"),
}


def _with_text_dates(name: str, final: str) -> str:
    if name not in DATES:
        return final
    texts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in DATES[name])
    return f"SELECT * REPLACE ({texts}) FROM ({final})"


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {PRELUDE}, {MARTS} {_with_text_dates(name, final)}" for name, final in FINAL.items()}
