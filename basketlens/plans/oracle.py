"""The registered queries in plain SQL over the source tables, for result comparison.

``prelude`` derives the cleaned tables with common table expressions; it shares no code with
the Spark plans.
"""

from basketlens.plans.queries import CATALOGUE

# Written out here, so that a wrong constant in the operators does not agree with itself.
FEATURES = ["user_total_orders",
            "user_avg_order_interval",
            "user_avg_basket_size",
            "user_reorder_rate",
            "user_unique_departments",
            "user_days_since_last_order"]
TABLES = ["benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
          "lineitem", "nation", "orders", "pages", "part", "region", "supplier"]
STRATEGIES = {
    "High-Value Frequent Loyalists":
        "VIP Retention: Offer priority delivery slots and exclusive early access.",
    "Full-Pantry Bulk Shoppers":
        "Volume Incentive: Promote bulk pantry bundles and subscription discounts.",
    "Routine Convenience Buyers":
        "Basket Building: Recommend cross-sell essentials to increase item count.",
    "Occasional / At-Risk Shoppers":
        "Win-Back Campaign: Trigger 14-day re-engagement discounts to curb churn."}
DEFAULT_STRATEGY = "Standard Engagement"
DESCRIPTIONS = {
    "Loyalist": "Weekly habitual regular with the highest order frequency and loyalty "
                "stickiness. Reorders routine grocery staples consistently.",
    "Bulk": "Full-pantry restocker. Buys high volume across 10+ grocery departments with the "
            "highest basket item count.",
    "Convenience": "Quick grab-and-go customer. Orders smaller targeted carts on a predictable "
                   "weekly cadence."}
OTHER_DESCRIPTION = ("Dormant / churn-risk shopper. High elapsed days since last order. Needs "
                     "automated win-back re-engagement incentives.")


def prelude(grain):
    item = "p_partkey" if grain == "product" else "aisle_id"
    label = "product_name" if grain == "product" else "aisle"
    return f"""
WITH numbered AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS back,
    CAST(o_orderdate AS DATE) - lag(CAST(o_orderdate AS DATE))
      OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS gap
  FROM orders),
raw_orders AS (
  SELECT order_id, user_id,
    CASE WHEN back > 1 THEN 'prior' WHEN user_id % 3 <> 0 THEN 'train' ELSE 'test' END AS eval_set,
    CAST(order_number AS BIGINT) AS order_number,
    CAST(extract(dow FROM order_date) AS BIGINT) AS order_dow,
    CAST(order_id % 24 AS BIGINT) AS order_hour_of_day,
    CAST(gap AS DOUBLE) AS days_since_prior_order, order_date
  FROM numbered),
d_orders AS (
  SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
    coalesce(days_since_prior_order, 0.0) AS days_since_prior_order, order_date,
    CAST(CASE WHEN order_number = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_first_order
  FROM raw_orders),
codes AS (
  SELECT *, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
    WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS dept_no FROM part),
cat AS (
  SELECT p_partkey, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
    CAST(dept_no * 100 + CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS BIGINT) AS aisle_id,
    p_type || '/' || p_brand AS aisle, CAST(dept_no AS BIGINT) AS department_id,
    p_type AS department FROM codes),
d_departments AS (SELECT DISTINCT department_id, department FROM cat),
d_aisles AS (SELECT DISTINCT aisle_id, aisle FROM cat),
d_products AS (
  SELECT DISTINCT CAST({item} AS BIGINT) AS product_id, trim({label}) AS product_name, aisle_id,
    department_id FROM cat),
raw_lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id,
    CAST(l_linenumber AS BIGINT) AS add_to_cart_order FROM lineitem),
single AS (
  SELECT l_orderkey AS order_id, CAST({item} AS BIGINT) AS product_id, min(l_linenumber) AS pos
  FROM lineitem JOIN cat ON l_partkey = p_partkey GROUP BY 1, 2),
d_lines AS (
  SELECT s.order_id, s.product_id,
    CAST(row_number() OVER (PARTITION BY s.order_id ORDER BY s.pos, s.product_id) AS BIGINT)
      AS add_to_cart_order,
    CAST(CASE WHEN o.order_number > min(o.order_number)
      OVER (PARTITION BY o.user_id, s.product_id) THEN 1 ELSE 0 END AS BIGINT) AS reordered,
    o.user_id, o.order_number, o.eval_set
  FROM single s JOIN raw_orders o ON s.order_id = o.order_id),
d_customers AS (
  SELECT user_id, CAST(max(order_number) AS BIGINT) AS total_orders,
    CAST(max(CASE WHEN eval_set = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS has_train_order,
    CAST(max(CASE WHEN eval_set = 'test' THEN 1 ELSE 0 END) AS BIGINT) AS has_test_order
  FROM d_orders GROUP BY user_id),
counts AS (
  SELECT product_id, CAST(count(*) AS BIGINT) AS total_purchases,
    CAST(sum(reordered) AS BIGINT) AS total_reorders FROM d_lines GROUP BY product_id),
pf AS (
  SELECT p.product_id, p.product_name, p.aisle_id, p.department_id,
    CAST(coalesce(n, 0) AS BIGINT) AS prod_total_orders,
    coalesce(round(CAST(again AS DOUBLE) / n, 4), 0.0) AS prod_reorder_rate,
    coalesce(round(CAST(cart AS DOUBLE) / n, 2), 0.0) AS prod_avg_add_to_cart
  FROM d_products p LEFT JOIN (
    SELECT product_id, count(*) AS n, sum(reordered) AS again, sum(add_to_cart_order) AS cart
    FROM d_lines WHERE eval_set = 'prior' GROUP BY 1) h USING (product_id)),
cf_orders AS (
  SELECT user_id, CAST(max(order_number) AS BIGINT) AS user_total_orders,
    avg(days_since_prior_order) AS user_avg_order_interval,
    coalesce(stddev_samp(days_since_prior_order), 0.0) AS user_std_order_interval,
    arg_max(days_since_prior_order, order_number) AS user_days_since_last_order
  FROM d_orders WHERE eval_set = 'prior' GROUP BY user_id),
cf_dow AS (
  SELECT user_id, order_dow AS user_preferred_dow FROM (
    SELECT user_id, order_dow, row_number() OVER (
      PARTITION BY user_id ORDER BY count(*) DESC, order_dow) AS rn
    FROM d_orders WHERE eval_set = 'prior' GROUP BY 1, 2) WHERE rn = 1),
cf_hour AS (
  SELECT user_id, order_hour_of_day AS user_preferred_hour FROM (
    SELECT user_id, order_hour_of_day, row_number() OVER (
      PARTITION BY user_id ORDER BY count(*) DESC, order_hour_of_day) AS rn
    FROM d_orders WHERE eval_set = 'prior' GROUP BY 1, 2) WHERE rn = 1),
cf_items AS (
  SELECT user_id, CAST(count(*) AS BIGINT) AS user_total_items,
    CAST(sum(reordered) AS BIGINT) AS user_total_reorders,
    round(CAST(sum(reordered) AS DOUBLE) / count(*), 4) AS user_reorder_rate,
    CAST(count(DISTINCT product_id) AS BIGINT) AS user_unique_products,
    CAST(count(DISTINCT department_id) AS BIGINT) AS user_unique_departments,
    CAST(count(DISTINCT aisle_id) AS BIGINT) AS user_unique_aisles
  FROM d_lines LEFT JOIN d_products USING (product_id) WHERE eval_set = 'prior'
  GROUP BY user_id),
cf AS (
  SELECT o.*, user_preferred_dow, user_preferred_hour,
    coalesce(user_total_items, 0) AS user_total_items,
    coalesce(user_total_reorders, 0) AS user_total_reorders,
    coalesce(user_reorder_rate, 0.0) AS user_reorder_rate,
    coalesce(user_unique_products, 0) AS user_unique_products,
    coalesce(user_unique_departments, 0) AS user_unique_departments,
    coalesce(user_unique_aisles, 0) AS user_unique_aisles,
    round(CAST(coalesce(user_total_items, 0) AS DOUBLE) / user_total_orders, 2)
      AS user_avg_basket_size
  FROM cf_orders o JOIN cf_dow USING (user_id) JOIN cf_hour USING (user_id)
  LEFT JOIN cf_items i ON o.user_id = i.user_id),
cohort AS (
  SELECT DISTINCT user_id FROM d_orders WHERE eval_set = 'train' ORDER BY user_id LIMIT 25000),
ups AS (
  SELECT user_id, product_id, CAST(count(*) AS BIGINT) AS up_total_orders,
    CAST(min(order_number) AS BIGINT) AS first_order_number,
    CAST(max(order_number) AS BIGINT) AS last_order_number,
    CAST(sum(add_to_cart_order) AS BIGINT) AS cart_sum
  FROM d_lines WHERE eval_set = 'prior' GROUP BY 1, 2),
upf AS (
  SELECT u.user_id, u.product_id, up_total_orders,
    round(CAST(up_total_orders AS DOUBLE) / user_total_orders, 4) AS up_order_rate,
    user_total_orders - last_order_number AS up_orders_since_last,
    round(CAST(cart_sum AS DOUBLE) / up_total_orders, 2) AS up_avg_add_to_cart,
    CAST(CASE WHEN EXISTS (SELECT 1 FROM d_lines t WHERE t.eval_set = 'train'
      AND t.user_id = u.user_id AND t.product_id = u.product_id) THEN 1 ELSE 0 END AS BIGINT)
      AS target
  FROM ups u JOIN (SELECT DISTINCT user_id FROM d_orders WHERE eval_set = 'train') tu
    USING (user_id) JOIN cf_orders USING (user_id)),
labelled AS (
  SELECT *, CAST((CASE WHEN user_total_orders > 9 THEN 2 ELSE 0 END)
    + (CASE WHEN user_avg_basket_size > 4 THEN 1 ELSE 0 END) AS BIGINT) AS cluster FROM cf),
personas AS (
  SELECT cluster, CASE
    WHEN avg(user_total_orders) > 9 AND avg(user_reorder_rate) > 0.05
      THEN 'High-Value Frequent Loyalists'
    WHEN avg(user_avg_basket_size) > 4 AND avg(user_unique_departments) > 5
      THEN 'Full-Pantry Bulk Shoppers'
    WHEN avg(user_avg_order_interval) > 200 OR avg(user_days_since_last_order) > 260
      THEN 'Occasional / At-Risk Shoppers'
    ELSE 'Routine Convenience Buyers' END AS segment_name
  FROM labelled GROUP BY cluster),
segs AS (SELECT l.*, segment_name FROM labelled l JOIN personas USING (cluster)),
bought AS (
  SELECT user_id AS source, product_id AS target, CAST(count(*) AS BIGINT) AS order_count,
    CAST(sum(reordered) AS BIGINT) AS reorders_count, 'BOUGHT' AS type
  FROM d_lines GROUP BY 1, 2),
allpairs AS (
  SELECT a.product_id AS source, b.product_id AS target, CAST(count(*) AS BIGINT) AS co_occurrence
  FROM d_lines a JOIN d_lines b ON a.order_id = b.order_id AND a.product_id < b.product_id
  GROUP BY 1, 2),
edges AS (
  SELECT *, 'OFTEN_BOUGHT_WITH' AS type FROM allpairs
  WHERE co_occurrence >= {25 if grain == 'aisle' else 2}),
timeline AS (
  SELECT order_id, user_id, order_number,
    CAST(sum(days_since_prior_order) OVER (PARTITION BY user_id ORDER BY order_number) AS BIGINT)
      AS cumulative_days FROM d_orders),
dated AS (
  SELECT *, DATE '2025-01-01' + CAST(cumulative_days AS INTEGER) AS order_date FROM timeline),
vol AS (
  SELECT 'platform' AS series_key, order_date AS ds, CAST(count(*) AS BIGINT) AS y FROM dated
  WHERE order_date BETWEEN DATE '2025-01-01' AND DATE '2025-10-31' GROUP BY 2),
allvol AS (
  SELECT 'platform' AS series_key, order_date AS ds, CAST(count(*) AS BIGINT) AS y FROM dated
  GROUP BY 2),
realvol AS (
  SELECT 'platform' AS series_key, order_date AS ds, CAST(count(*) AS BIGINT) AS y
  FROM d_orders GROUP BY 2),
deptvol AS (
  SELECT CAST(department_id AS VARCHAR) AS series_key, order_date AS ds,
    CAST(count(DISTINCT l.order_id) AS BIGINT) AS y
  FROM d_lines l JOIN d_products USING (product_id) JOIN d_orders o ON l.order_id = o.order_id
  GROUP BY 1, 2),
vol_f AS ({_filled('allvol')}),
real_f AS ({_filled('realvol')}),
dept_f AS ({_filled('deptvol')}),
aislevol AS (
  SELECT CAST(aisle_id AS VARCHAR) AS series_key, order_date AS ds,
    CAST(count(DISTINCT l.order_id) AS BIGINT) AS y
  FROM d_lines l JOIN d_products USING (product_id) JOIN d_orders o ON l.order_id = o.order_id
  GROUP BY 1, 2),
aisle_f AS ({_filled('aislevol')}),
aisle_h AS ({_held('aisle_f')}),
vol_h AS ({_held('vol_f')}),
dept_h AS ({_held('dept_f')}),
sma AS ({_average('vol_h')}),
dept_sma AS ({_average('dept_h')}),
matrix AS (
  SELECT u.*, c.user_total_orders, user_avg_order_interval, user_avg_basket_size,
    user_reorder_rate, user_unique_departments, prod_total_orders, prod_reorder_rate,
    prod_avg_add_to_cart
  FROM upf u LEFT JOIN cf c ON u.user_id = c.user_id LEFT JOIN pf p ON u.product_id = p.product_id),
hashed AS (
  SELECT *, ((user_id % 2147483648) * 2654435761) % 4294967296 / 4294967296.0 AS user_hash,
    ((((((user_id % 2147483648) * 1103515245 + 12345) % 2147483647
      + product_id % 2147483648) * 1566083941) % 2147483647) * 48271 + 11) % 2147483647
      / 2147483647.0 AS pair_hash FROM matrix),
scored AS (
  SELECT 'blend' AS model, target, CAST(least(greatest(
      CAST(prod_reorder_rate AS DECIMAL(12, 4)) * 0.4
      + CAST(user_reorder_rate AS DECIMAL(12, 4)) * 0.6, 0.05), 0.95) AS DOUBLE) AS score
    FROM hashed WHERE user_hash >= 0.8
  UNION ALL
  SELECT 'order_rate', target, least(up_order_rate, 1.0) FROM hashed WHERE user_hash >= 0.8),
ranked_scores AS (
  SELECT *, rank() OVER (PARTITION BY model ORDER BY score)
      + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS midrank FROM scored),
auc AS (
  SELECT model, round((sum(CASE WHEN target = 1 THEN midrank END)
      - sum(target) * (sum(target) + 1) / 2.0)
      / (CAST(sum(target) AS DOUBLE) * (count(*) - sum(target))), 4) AS roc_auc
  FROM ranked_scores GROUP BY model),
ap AS (
  SELECT model, round(sum(pos * CAST(tp AS DOUBLE) / flagged) / max(tp), 4) AS pr_auc FROM (
    SELECT model, score, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS flagged FROM (
      SELECT model, score, sum(target) AS pos, count(*) AS n FROM scored GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY model ORDER BY score DESC)) GROUP BY model)
"""


def _filled(name):
    return f"""
  SELECT series_key, ds, last_value(y IGNORE NULLS) OVER (
    PARTITION BY series_key ORDER BY ds ROWS UNBOUNDED PRECEDING) AS y
  FROM (SELECT series_key, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE)
          AS ds FROM {name} GROUP BY 1) d LEFT JOIN {name} USING (series_key, ds)"""


def _held(name):
    return f"""
  SELECT *, ds > max(ds) OVER (PARTITION BY series_key) - 30 AS is_holdout FROM {name}"""


def _average(name):
    return f"""
  SELECT series_key, '7-Day Moving Average (Baseline)' AS model, ds, CAST(y AS DOUBLE) AS y,
    predicted FROM (
    SELECT *, avg(y) OVER (PARTITION BY series_key ORDER BY ds
      ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS predicted FROM {name}) WHERE is_holdout"""


def _errors(name):
    return f"""
SELECT series_key, model, round(avg(abs(y - predicted)), 2) AS mae,
  round(sqrt(avg((y - predicted) * (y - predicted))), 2) AS rmse,
  round(avg(abs((y - predicted) / greatest(y, 1.0))) * 100, 2) AS mape
FROM {name} GROUP BY 1, 2"""


def _thresholds(values):
    rows = ", ".join(f"({v})" for v in values)
    return f"""
SELECT model, threshold, tp, fp, fn, tn,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE round(CAST(tp AS DOUBLE) / (tp + fp), 4) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE round(CAST(tp AS DOUBLE) / (tp + fn), 4) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0
    ELSE round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 4) END AS f1_score
FROM (SELECT model, CAST(threshold AS DOUBLE) AS threshold,
  CAST(count(*) FILTER (score >= threshold AND target = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (score >= threshold AND target = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (score < threshold AND target = 1) AS BIGINT) AS fn,
  CAST(count(*) FILTER (score < threshold AND target = 0) AS BIGINT) AS tn
  FROM scored, (VALUES {rows}) t(threshold) GROUP BY 1, 2)"""


def _case(column, mapping, other):
    whens = " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE '{other}' END"


def _union(parts):
    return " UNION ALL ".join(parts)


def _profile(table, columns):
    return _union([f"""
SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(*) - count({c}) AS BIGINT) AS null_count,
  round((count(*) - count({c})) / CAST(count(*) AS DOUBLE) * 100, 2) AS null_pct,
  {f'CAST(min({c}) AS DOUBLE)' if numeric else 'CAST(NULL AS DOUBLE)'} AS min_value,
  {f'CAST(max({c}) AS DOUBLE)' if numeric else 'CAST(NULL AS DOUBLE)'} AS max_value
FROM {table}""" for c, numeric in columns])


def _foreign(relation, child, key, parent):
    return f"""
SELECT '{relation}' AS foreign_key,
  CASE WHEN count(DISTINCT {key}) FILTER ({key} NOT IN (SELECT {key} FROM {parent})) = 0
    THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(count(DISTINCT {key}) FILTER ({key} NOT IN (SELECT {key} FROM {parent})) AS BIGINT)
    AS orphan_count,
  CAST(count(*) AS BIGINT) AS rows_checked FROM {child}"""


def _foreign_keys(prior, train):
    return _union([
        _foreign("products.aisle_id -> aisles.aisle_id", "d_products", "aisle_id", "d_aisles"),
        _foreign("products.department_id -> departments.department_id", "d_products",
                 "department_id", "d_departments"),
        _foreign("prior_lines.order_id -> orders.order_id (prior)", prior, "order_id",
                 "(SELECT order_id FROM raw_orders WHERE eval_set = 'prior')"),
        _foreign("prior_lines.product_id -> products.product_id", prior, "product_id",
                 "d_products"),
        _foreign("train_lines.order_id -> orders.order_id (train)", train, "order_id",
                 "(SELECT order_id FROM raw_orders WHERE eval_set = 'train')"),
        _foreign("train_lines.product_id -> products.product_id", train, "product_id",
                 "d_products")])


def _unique(table, key):
    return f"""
SELECT '{table}' AS table_name, 'UNIQUE ({key})' AS rule, CAST(count(*) AS BIGINT) AS violations
FROM (SELECT {key} FROM {_at(table)} GROUP BY {key} HAVING count(*) > 1)"""


def _required(table, column):
    return f"""
SELECT '{table}' AS table_name, 'NOT NULL ({column})' AS rule,
  CAST(count(*) - count({column}) AS BIGINT) AS violations FROM {_at(table)}"""


def _at(table):
    return {"orders": "raw_orders", "raw_lines": "raw_lines"}.get(table, f"d_{table}")


def _named(table, columns):
    names = ", ".join(columns)
    return (f"SELECT '{table}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
            f"'{names}' AS columns FROM ")


PROFILE = _union([
    _profile("raw_orders", [("order_id", 1), ("user_id", 1), ("eval_set", 0), ("order_number", 1),
                            ("order_dow", 1), ("order_hour_of_day", 1),
                            ("days_since_prior_order", 1)]).replace("'raw_orders'", "'orders'"),
    _profile("d_products", [("product_id", 1), ("product_name", 0), ("aisle_id", 1),
                            ("department_id", 1)]).replace("'d_products'", "'products'"),
    _profile("d_aisles", [("aisle_id", 1), ("aisle", 0)]).replace("'d_aisles'", "'aisles'"),
    _profile("d_departments", [("department_id", 1), ("department", 0)]
             ).replace("'d_departments'", "'departments'"),
    _profile("raw_lines", [("order_id", 1), ("product_id", 1), ("add_to_cart_order", 1)])])

TOP = """
SELECT product_id, product_name, department, aisle, total_purchases, total_reorders,
  round(CAST(total_reorders AS DOUBLE) / total_purchases, 4) AS reorder_rate
FROM counts JOIN d_products USING (product_id) JOIN d_departments USING (department_id)
JOIN d_aisles USING (aisle_id) ORDER BY {by} DESC, product_id LIMIT 20"""

SUMMARY = """
SELECT user_id, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
  min(order_number) AS first_order_number, max(order_number) AS max_order_number,
  avg(days_since_prior_order) AS avg_days_between_orders,
  avg(order_hour_of_day) AS avg_order_hour FROM d_orders GROUP BY user_id"""

HOURS = ", ".join(f"CAST(count(*) FILTER (order_hour_of_day = {h}) AS BIGINT) AS h{h:02d}"
                  for h in range(24))
DOW = ("CASE order_dow WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' "
       "WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' "
       "WHEN 6 THEN 'Saturday' END")
SIZES = "(SELECT order_id, count(*) AS n FROM d_lines GROUP BY 1)"

CORRELATED = ["user_total_orders", "user_avg_order_interval", "user_avg_basket_size",
              "user_reorder_rate", "user_unique_departments"]

TARGETS = "(SELECT user_id FROM cf WHERE user_id % 100 = 0)"

NEAR = f"""
SELECT user_id, other, common_products, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY common_products DESC, other) AS rank
  FROM (SELECT t.source AS user_id, o.source AS other, CAST(count(*) AS BIGINT) AS common_products
    FROM bought t JOIN bought o ON t.target = o.target AND t.source <> o.source
    WHERE t.source IN {TARGETS} GROUP BY 1, 2)) WHERE rank <= 15"""

BOTH = """(SELECT source, target, co_occurrence FROM edges
  UNION ALL SELECT target, source, co_occurrence FROM edges)"""


def _bought_together(limit):
    return f"""
SELECT b.source AS source_product_id, s.product_name AS source_product_name,
  CAST(rank AS BIGINT) AS rank, b.target AS product_id, t.product_name,
  co_occurrence AS times_co_purchased
FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY co_occurrence DESC, target)
  AS rank FROM {BOTH}) b JOIN d_products s ON s.product_id = b.source
JOIN d_products t ON t.product_id = b.target WHERE rank <= {limit}"""


def _recursion(source, where="NOT is_holdout", grid=((0.3, 0.05, 0.2),)):
    """CTEs ``states``: level, trend, season and squared errors of each series after all its
    values, for the candidate parameters with the smallest error."""
    values = ", ".join(f"({a}, {b}, {g})" for a, b, g in grid)
    return f""", series AS (
  SELECT series_key, ds, CAST(y AS DOUBLE) AS y, NOT ({where}) AS is_holdout,
    row_number() OVER (PARTITION BY series_key ORDER BY ds) AS t FROM {source}),
sizes AS (
  SELECT series_key, count(*) FILTER (NOT is_holdout) AS n FROM series GROUP BY 1),
start AS (
  SELECT series_key, avg(y) FILTER (t <= 7) AS l0,
    (avg(y) FILTER (t > 7 AND t <= 14) - avg(y) FILTER (t <= 7)) / 7 AS b0,
    list(y ORDER BY t) FILTER (t <= 7) AS first_week
  FROM series JOIN sizes USING (series_key) WHERE n >= 14 GROUP BY 1),
steps AS (
  WITH RECURSIVE r AS (
    SELECT series_key, alpha, beta, gamma, CAST(0 AS BIGINT) AS t, l0 AS level, b0 AS trend,
      list_transform(first_week, lambda x: x - l0) AS season, CAST(0 AS DOUBLE) AS sse
    FROM start, (SELECT CAST(a AS DOUBLE) AS alpha, CAST(b AS DOUBLE) AS beta,
      CAST(g AS DOUBLE) AS gamma FROM (VALUES {values}) v(a, b, g))
    UNION ALL
    SELECT series_key, alpha, beta, gamma, t, old_level + old_trend + alpha * miss AS level,
      old_trend + alpha * beta * miss AS trend,
      list_append(season[2:7], season[1] + gamma * miss) AS season, sse + miss * miss AS sse
    FROM (SELECT s.series_key, alpha, beta, gamma, s.t, r.level AS old_level,
        r.trend AS old_trend, r.season, sse, s.y - r.level - r.trend - r.season[1] AS miss
      FROM r JOIN series s ON s.series_key = r.series_key AND s.t = r.t + 1
      WHERE NOT s.is_holdout))
  SELECT * FROM r),
states AS (
  SELECT * FROM (SELECT steps.*, n, row_number() OVER (
      PARTITION BY series_key ORDER BY sse, alpha, beta, gamma) AS place
    FROM steps JOIN sizes USING (series_key) WHERE t = n) WHERE place = 1)"""


def _smoothing(source, grid=((0.3, 0.05, 0.2),)):
    return _recursion(source, grid=grid) + """
SELECT series_key, 'Holt-Winters Exp Smoothing' AS model, CAST(ds AS VARCHAR) AS ds, y,
  round(level + (series.t - sizes.n) * trend
    + season[CAST((series.t - sizes.n - 1) % 7 + 1 AS BIGINT)], 4) AS predicted
FROM series JOIN sizes USING (series_key) LEFT JOIN states USING (series_key)
WHERE is_holdout"""


#: The platform's next 30 days by smoothing, with a band from the one-step errors.
SMOOTHED = _recursion("vol_f", "true") + """,
ahead AS (
  SELECT h, level + h * trend + season[CAST((h - 1) % 7 + 1 AS BIGINT)] AS mean,
    1.959964 * sqrt(sse / n * (1 + coalesce((SELECT sum(power(alpha + alpha * beta * j
      + CASE WHEN j % 7 = 0 THEN gamma ELSE 0 END, 2)) FROM generate_series(1, 29) q(j)
      WHERE j < h), 0))) AS reach
  FROM states, generate_series(1, 30) p(h)),
fc AS (
  SELECT strftime((SELECT max(ds) FROM vol_f) + CAST(h AS INTEGER), '%Y-%m-%d') AS forecast_date,
    CAST(round(mean) AS BIGINT) AS predicted_demand,
    CAST(round(greatest(mean - reach, 0)) AS BIGINT) AS lower_ci_95,
    CAST(round(mean + reach) AS BIGINT) AS upper_ci_95 FROM ahead)
"""


# --- seasonal ARIMA: the same descent, as recursions over lists ----------------------------

POINT = ("phi", "theta", "sphi", "stheta")
MISS = ("(x.w1 - phi * s.w1 - sphi * s.w7 + phi * sphi * s.w8 - theta * s.e1 - stheta * s.e7 "
        "- theta * stheta * s.e8)")
ZERO = "CAST(0 AS DOUBLE)"


def _named_fields(fields):
    return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"


def _pushed(name, new):
    """The newest of eight values of a sequence and the seven before it."""
    return {f"{name}1": new} | {f"{name}{i}": f"s.{name}{i - 1}" for i in range(2, 9)}


def _slope(name, source):
    """Derivative of the error from that of its source; errors of the past depend on it too."""
    return (f"({source} - theta * s.{name}1 - stheta * s.{name}7 "
            f"- theta * stheta * s.{name}8)")


#: Squared errors along the list, without the first one, which no parameter changes.
ERRORS = _pushed("w", "x.w1") | _pushed("e", MISS) | {
    "n": "s.n + 1", "sse": f"s.sse + CASE WHEN s.n > 0 THEN {MISS} * {MISS} ELSE 0 END",
    "late": f"s.late + CASE WHEN s.n > 7 THEN {MISS} * {MISS} ELSE 0 END"}
#: The same with gradient and normal matrix. Sums take the newest of the state, so they lag a step.
SLOPES = (_pushed("w", "x.w1") | _pushed("e", MISS)
          | _pushed("a", _slope("a", "sphi * s.w8 - s.w1"))
          | _pushed("b", _slope("b", "-s.e1 - stheta * s.e8"))
          | _pushed("c", _slope("c", "phi * s.w8 - s.w7"))
          | _pushed("d", _slope("d", "-s.e7 - theta * s.e8"))
          | {"n": "s.n + 1", "sse": "s.sse + CASE WHEN s.n > 1 THEN s.e1 * s.e1 ELSE 0 END"}
          | {f"g{i}": f"s.g{i} + s.e1 * s.{v}1" for i, v in enumerate("abcd", 1)}
          | {f"h{i}{j}": f"s.h{i}{j} + s.{v}1 * s.{u}1" for i, v in enumerate("abcd", 1)
             for j, u in enumerate("abcd"[:i], 1)})


def _folded(fields, values):
    zeros = _named_fields({k: ZERO for k in fields})
    return f"list_reduce({values}, lambda s, x: {_named_fields(fields)}, {zeros})"


def _differences(fields):
    start = {k: ZERO for k in fields} | {"w1": "y[i] - y[i - 1] - y[i - 7] + y[i - 8]"}
    return f"list_transform(range(9, len(y) + 1), lambda i: {_named_fields(start)})"


def _arima(source, where="true", horizon=30):
    """CTEs ``best``: parameters and state per series, and ``path``: means and psi weights ahead."""
    axis = "(SELECT unnest([-0.6, 0.0, 0.6]) AS v, generate_subscripts([1, 2, 3], 1) AS i)"
    fixed = [f"({p} <= -0.98 AND g.g{i} > 0 OR {p} >= 0.98 AND g.g{i} < 0)"
             for i, p in enumerate(POINT, 1)]
    masked = [f"CASE WHEN f{i} THEN 0 ELSE g.g{i} END AS z{i}" for i in range(1, 5)]
    for i in range(1, 5):
        masked += [f"CASE WHEN f{i} OR f{j} THEN 0 ELSE g.h{i}{j} END AS m{i}{j}"
                   for j in range(1, i)]
        masked.append(f"CASE WHEN f{i} THEN 1 ELSE g.h{i}{i} * (1 + damp) + 1e-12 END AS m{i}{i}")
    solved = """m11 AS d1, m21 / d1 AS l21, m31 / d1 AS l31, m41 / d1 AS l41,
      m22 - l21 * l21 * d1 AS d2, (m32 - l31 * l21 * d1) / d2 AS l32,
      (m42 - l41 * l21 * d1) / d2 AS l42, m33 - l31 * l31 * d1 - l32 * l32 * d2 AS d3,
      (m43 - l41 * l31 * d1 - l42 * l32 * d2) / d3 AS l43,
      m44 - l41 * l41 * d1 - l42 * l42 * d2 - l43 * l43 * d3 AS d4,
      z1 AS y1, z2 - l21 * y1 AS y2, z3 - l31 * y1 - l32 * y2 AS y3,
      z4 - l41 * y1 - l42 * y2 - l43 * y3 AS y4,
      y4 / d4 AS x4, y3 / d3 - l43 * x4 AS x3, y2 / d2 - l32 * x3 - l42 * x4 AS x2,
      y1 / d1 - l21 * x2 - l31 * x3 - l41 * x4 AS x1"""
    moved = ", ".join(f"greatest(-0.98, least(0.98, {p} - x{i})) AS {p}"
                      for i, p in enumerate(POINT, 1))
    names = ", ".join(POINT)
    held = ", ".join(f"CASE WHEN better THEN {p} ELSE old_{p} END AS {p}" for p in POINT)
    olds = ", ".join(f"{p} AS old_{p}" for p in POINT)
    last = "[" + ", ".join(f"t.{{0}}{i}" for i in range(8, 0, -1)) + "]"
    return f""", ys AS (
  SELECT series_key, list(CAST(y AS DOUBLE) ORDER BY ds) AS y, max(ds) AS last_day FROM {source}
  WHERE {where} GROUP BY 1),
ws AS MATERIALIZED (
  SELECT series_key, y, last_day, {_differences(ERRORS)} AS w, {_differences(SLOPES)} AS wide FROM ys
  WHERE len(y) >= 28),
grid AS (
  SELECT CAST(a.v AS DOUBLE) AS phi, CAST(b.v AS DOUBLE) AS theta, CAST(c.v AS DOUBLE) AS sphi,
    CAST(d.v AS DOUBLE) AS stheta, a.i * 27 + b.i * 9 + c.i * 3 + d.i AS corner
  FROM {axis} a, {axis} b, {axis} c, {axis} d),
starts AS MATERIALIZED (
  SELECT * FROM (SELECT series_key, {names}, row_number() OVER (
      PARTITION BY series_key ORDER BY {_folded(ERRORS, "w")}.sse, corner) AS start FROM grid, ws)
  WHERE start <= 2),
descents AS MATERIALIZED (
  WITH RECURSIVE r AS (
    SELECT series_key, start, 0 AS round, {names},
      {_folded(SLOPES, "list_append(wide, wide[1])")} AS g, CAST(0.001 AS DOUBLE) AS damp,
      true AS open FROM starts JOIN ws USING (series_key)
    UNION ALL
    SELECT series_key, start, round + 1, {held}, CASE WHEN better THEN t ELSE g END AS g,
      CASE WHEN better THEN damp / 5 ELSE damp * 4 END AS damp,
      NOT (better AND 1 - t.sse / g.sse < 1e-9 OR NOT better AND damp * 4 > 1e9) AS open
    FROM (SELECT *, t.sse < g.sse AS better FROM (
      SELECT series_key, start, round, {names}, {", ".join(f"old_{p}" for p in POINT)}, g, damp,
        {_folded(SLOPES, "list_append(wide, wide[1])")} AS t
      FROM (SELECT series_key, start, round, g, damp, {olds}, {moved} FROM (
        SELECT *, {solved} FROM (SELECT *, {", ".join(masked)} FROM (
          SELECT *, {", ".join(f"{f} AS f{i}" for i, f in enumerate(fixed, 1))}
          FROM r WHERE open AND round < 60)))) JOIN ws USING (series_key))))
  SELECT * FROM r),
best AS MATERIALIZED (
  SELECT series_key, {names}, last_day, y, {_folded(ERRORS, "w")} AS t FROM (
    SELECT series_key, {names}, row_number() OVER (PARTITION BY series_key ORDER BY g.sse, start)
      AS place FROM (SELECT *, row_number() OVER (PARTITION BY series_key, start
        ORDER BY round DESC) AS back FROM descents) WHERE back = 1)
  JOIN ws USING (series_key) WHERE place = 1),
path AS (
  WITH RECURSIVE r AS (
    SELECT series_key, {names}, 'mean' AS kind, 0 AS h, {last.format("w")} AS w,
      {last.format("e")} AS e, y[len(y) - 7:] AS v FROM best
    UNION ALL
    SELECT series_key, {names}, 'psi', 0, u, u, u FROM best,
      (SELECT CAST([0, 0, 0, 0, 0, 0, 0, 1] AS DOUBLE[]) AS u)
    UNION ALL
    SELECT series_key, {names}, kind, h + 1, list_append(w[2:], next), list_append(e[2:], {ZERO}),
      list_append(v[2:], next + v[8] + v[2] - v[1]) FROM (
      SELECT *, phi * w[8] + sphi * w[2] - phi * sphi * w[1] + theta * e[8] + stheta * e[2]
        + theta * stheta * e[1] AS next FROM r WHERE h < {horizon}))
  SELECT series_key, kind, h, v[8] AS value FROM r)"""


def _arima_ahead(source):
    return _arima(source) + """,
ahead AS (
  SELECT series_key, last_day, h, value AS mean, 1.959964 * sqrt(t.late / (t.n - 8) * (
    SELECT sum(value * value) FROM path q WHERE q.series_key = p.series_key AND kind = 'psi'
      AND q.h < p.h)) AS reach
  FROM path p JOIN best USING (series_key) WHERE kind = 'mean' AND h > 0),
fcs AS (
  SELECT series_key, strftime(last_day + CAST(h AS INTEGER), '%Y-%m-%d') AS forecast_date,
    CAST(round(mean) AS BIGINT) AS predicted_demand,
    CAST(round(greatest(mean - reach, 0)) AS BIGINT) AS lower_ci_95,
    CAST(round(mean + reach) AS BIGINT) AS upper_ci_95 FROM ahead),
fc AS (SELECT * EXCLUDE (series_key) FROM fcs)
"""


#: The platform's next 30 days from the seasonal ARIMA fitted to all of them.
FORECAST = _arima_ahead("vol_f")


def _boxplot():
    q = ", ".join(f"quantile_cont(up_order_rate, {p}) AS {n}" for n, p in
                  [("minimum", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75),
                   ("maximum", 1.0)])
    return f"""
SELECT target, round(minimum, 4) AS minimum, round(q1, 4) AS q1, round(median, 4) AS median,
  round(q3, 4) AS q3, round(maximum, 4) AS maximum,
  min(up_order_rate) AS whisker_low, max(up_order_rate) AS whisker_high
FROM upf JOIN (SELECT target, {q} FROM upf GROUP BY 1) f USING (target)
WHERE up_order_rate BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
GROUP BY 1, 2, 3, 4, 5, 6"""


CF_ROUNDED = """SELECT * REPLACE (round(user_avg_order_interval, 4) AS user_avg_order_interval,
  round(user_std_order_interval, 4) AS user_std_order_interval) FROM """

R2 = """, popular AS (
  SELECT product_id, product_name, prod_reorder_rate,
    row_number() OVER (ORDER BY prod_total_orders DESC, product_id) AS place
  FROM pf ORDER BY place LIMIT 30),
offers AS (
  SELECT user_id, segment_name, product_id, product_name, place,
    least(greatest(CAST(prod_reorder_rate AS DECIMAL(12, 4)) * 0.4
      + CAST(user_reorder_rate AS DECIMAL(12, 4)) * 0.6, 0.05), 0.95) AS p
  FROM segs, popular)
SELECT s.user_id, s.segment_name AS customer_segment,
  CAST(count(product_id) OVER (PARTITION BY s.user_id) AS BIGINT) AS recommendations_count,
  CAST(rank AS BIGINT) AS rank, product_id, product_name,
  CAST(round(p, 4) AS DOUBLE) AS reorder_probability,
  CASE WHEN p >= 0.40 THEN 'High Priority' WHEN p IS NOT NULL THEN 'Medium Priority' END
    AS recommendation_tier
FROM segs s LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(p, 4) DESC, place) AS rank
  FROM offers WHERE p >= {threshold} QUALIFY rank <= 5) o ON o.user_id = s.user_id"""

HORIZON = FORECAST.replace("{", "{{").replace("}", "}}") + """SELECT CAST(count(*) AS BIGINT) AS forecast_horizon_days,
  CAST(sum(predicted_demand) AS BIGINT) AS total_projected_orders
FROM (SELECT * FROM fc ORDER BY forecast_date LIMIT {days})"""

KPIS = """, k AS (SELECT (SELECT count(*) FROM segs) AS n, (SELECT count(*) FROM pf) AS products,
  (SELECT count(*) FROM d_orders) AS orders_n,
  (SELECT avg(user_avg_basket_size) FROM segs) AS basket,
  (SELECT avg(user_reorder_rate) FROM segs) AS again,
  (SELECT roc_auc FROM auc WHERE model = 'blend') AS a,
  (SELECT mape FROM (""" + _errors("sma") + """)) AS m)
SELECT 'Total Registered Customers' AS metric_name, CAST(n AS DOUBLE) AS value,
  format('{:,}', n) AS formatted_value FROM k
UNION ALL SELECT 'Total Catalog Products', products, format('{:,}', products) FROM k
UNION ALL SELECT 'Platform Lifetime Orders', orders_n, format('{:,}', orders_n) FROM k
UNION ALL SELECT 'Average Basket Size', round(basket, 2), printf('%.1f items', basket) FROM k
UNION ALL SELECT 'Platform Reorder Rate', round(again * 100, 2), printf('%.1f%%', again * 100)
  FROM k
UNION ALL SELECT 'Supervised Prediction ROC-AUC', a, printf('%.2f%%', a * 100) FROM k
UNION ALL SELECT 'Forecast Error (MAPE)', m, printf('%.2f%%', m) FROM k"""

FIXED_BOARD = ("SELECT b.*, roc_auc, pr_auc FROM (" + _thresholds([0.05]) + ") b "
               "JOIN auc USING (model) JOIN ap USING (model) WHERE model = 'blend' UNION ALL "
               "SELECT b.*, roc_auc, pr_auc FROM (" + _thresholds([0.20]) + ") b "
               "JOIN auc USING (model) JOIN ap USING (model) WHERE model = 'order_rate'")

ITEM_STATS = """SELECT user_id, user_total_items, user_total_reorders, user_reorder_rate,
  user_unique_products, user_unique_departments, user_unique_aisles FROM cf_items"""

SQL = {
    "src_csv_orders": "SELECT * EXCLUDE (order_date) FROM raw_orders",
    "src_pruned_scan": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
    "src_discover": _union([
        f"SELECT '{t}' AS table_name, CAST(1 AS BIGINT) AS file_count, "
        f"CAST(count(*) AS BIGINT) AS row_count, true AS has_bytes FROM {t}" for t in TABLES]),
    "src_optional_missing": "SELECT source, target FROM edges",
    "src_report": "SELECT model, threshold, precision, recall, f1_score FROM ("
                  + _thresholds([0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50]) + ")",
    "src_key_sample": """SELECT CAST(count(*) AS BIGINT) AS order_count,
  CAST(sum(order_id) AS BIGINT) AS order_sum FROM d_orders
  WHERE ((user_id % 2147483648) * 2654435761) % 4294967296 / 4294967296.0 < 0.25""",
    "snk_upsert": """SELECT product_id, coalesce(t.lines, p.lines) AS lines,
  coalesce(t.latest, p.latest) AS latest
FROM (SELECT product_id, CAST(count(*) AS BIGINT) AS lines, max(order_number) AS latest
  FROM d_lines WHERE eval_set = 'prior' GROUP BY 1) p
FULL JOIN (SELECT product_id, CAST(count(*) AS BIGINT) AS lines, max(order_number) AS latest
  FROM d_lines WHERE eval_set = 'train' GROUP BY 1) t USING (product_id)""",
    "snk_bucket_upsert": """SELECT product_id, coalesce(t.lines, p.lines) AS lines,
  coalesce(t.latest, p.latest) AS latest
FROM (SELECT product_id, CAST(count(*) AS BIGINT) AS lines, max(order_number) AS latest
  FROM d_lines WHERE eval_set = 'prior' GROUP BY 1) p
FULL JOIN (SELECT product_id, CAST(count(*) AS BIGINT) AS lines, max(order_number) AS latest
  FROM d_lines WHERE eval_set = 'train' GROUP BY 1) t USING (product_id)""",
    "v9_written_values": _union([
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows_derived, "
        f"CAST(count(*) AS BIGINT) AS rows_written, true AS values_agree FROM d_{s}"
        for t, s in [("departments", "departments"), ("aisles", "aisles"), ("products", "products"),
                     ("customers", "customers"), ("orders", "orders"), ("order_products", "lines")]]),
    "e7_basket_sketch": """SELECT CAST(p AS DOUBLE) AS prob, CAST((SELECT count(DISTINCT order_id)
  FROM d_lines) AS BIGINT) AS order_count, true AS within_bound
FROM (VALUES (0.25), (0.5), (0.75), (0.95)) v(p)""",
    "snk_table_load": _union([
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {s}"
        for t, s in [("departments", "d_departments"), ("aisles", "d_aisles"),
                     ("products", "d_products"), ("customers", "d_customers"),
                     ("orders", "d_orders"), ("order_products", "d_lines")]]),
    "snk_union_csv": """SELECT order_id, product_id, add_to_cart_order, reordered
FROM d_lines WHERE eval_set IN ('prior', 'train')""",
    "snk_artifact_csv": "SELECT product_id, product_name, aisle_id, department_id FROM d_products",
    "v1_profile": PROFILE,
    "v2_duplicate_rows": _union([
        f"""SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {s})) AS BIGINT)
    AS duplicate_rows FROM {s}"""
        for t, s in [("raw_lines", "raw_lines"), ("orders", "raw_orders"),
                     ("products", "d_products")]]),
    "v3_sample_rows": """SELECT order_id, user_id, eval_set, order_number, days_since_prior_order
FROM raw_orders ORDER BY order_id LIMIT 5""",
    "v4_foreign_keys": _foreign_keys(*[
        "(SELECT l.* FROM raw_lines l LEFT JOIN raw_orders o ON l.order_id = o.order_id "
        f"WHERE coalesce(eval_set, 'prior') = '{split}')" for split in ("prior", "train")]),
    "v5_split_foreign_keys": _foreign_keys("raw_lines", "raw_lines"),
    "v6_split_sizes": """SELECT eval_set, CAST(count(*) AS BIGINT) AS order_count,
  CAST(count(DISTINCT user_id) AS BIGINT) AS user_count FROM raw_orders GROUP BY 1""",
    "v7_domain_rules": _union([
        f"""SELECT '{t}' AS table_name, '{n}' AS rule, CAST(count(*) AS BIGINT) AS rows_checked,
  CAST(count(*) FILTER ({c}) AS BIGINT) AS violations FROM {s}""" for t, s, n, c in [
            ("orders", "raw_orders", "order_dow in 0..6", "order_dow NOT BETWEEN 0 AND 6"),
            ("orders", "raw_orders", "order_hour_of_day in 0..23",
             "order_hour_of_day NOT BETWEEN 0 AND 23"),
            ("orders", "raw_orders", "gap is null only for the first order",
             "(order_number = 1) <> (days_since_prior_order IS NULL)"),
            ("order_products", "lineitem", "add_to_cart_order starts at 1", "l_linenumber < 1"),
            ("order_products", "lineitem", "quantity is positive", "l_quantity <= 0"),
            ("order_products", "lineitem", "discount in 0..1",
             "l_discount NOT BETWEEN 0 AND 1")]]),
    "v8_constraints": _union([
        _unique("departments", "department_id"), _required("departments", "department_id"),
        _required("departments", "department"), _unique("aisles", "aisle_id"),
        _required("aisles", "aisle_id"), _required("aisles", "aisle"),
        _unique("products", "product_id"), _required("products", "product_id"),
        _required("products", "product_name"), _unique("orders", "order_id"),
        _required("orders", "user_id"), _required("orders", "days_since_prior_order"),
        _unique("raw_lines", "order_id, product_id"),
        _required("raw_lines", "add_to_cart_order")]),
    "v9_table_counts": _union([
        _named("departments", ["department_id", "department"]) + "d_departments",
        _named("aisles", ["aisle_id", "aisle"]) + "d_aisles",
        _named("products", ["product_id", "product_name", "aisle_id", "department_id"])
        + "d_products",
        _named("customers", ["user_id", "total_orders", "has_train_order", "has_test_order"])
        + "d_customers",
        _named("orders", ["order_id", "user_id", "eval_set", "order_number", "order_dow",
                          "order_hour_of_day", "days_since_prior_order", "is_first_order"])
        + "d_orders",
        _named("order_products", ["order_id", "product_id", "add_to_cart_order", "reordered"])
        + "d_lines"]),
    "c1_products": "SELECT * FROM d_products",
    "c1_aisles": "SELECT * FROM d_aisles",
    "c1_departments": "SELECT * FROM d_departments",
    "c2_orders": "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM d_orders",
    "c3_customers": "SELECT * FROM d_customers",
    "c4_unified_lines": """SELECT reordered, CAST(count(*) AS BIGINT) AS line_count,
  CAST(sum(product_id) AS BIGINT) AS product_sum, CAST(sum(add_to_cart_order) AS BIGINT)
  AS cart_sum FROM d_lines WHERE eval_set IN ('prior', 'train') GROUP BY 1""",
    "c5_dedupe_report": """SELECT CAST(count(*) AS BIGINT) AS rows_before,
  CAST(count(DISTINCT (order_id, product_id)) AS BIGINT) AS rows_after,
  CAST(count(*) - count(DISTINCT (order_id, product_id)) AS BIGINT) AS rows_removed
FROM raw_lines""",
    "c5_deduped_lines": """SELECT order_id, product_id, CAST(row_number() OVER (
  PARTITION BY order_id ORDER BY min(add_to_cart_order), product_id) AS BIGINT)
  AS add_to_cart_order FROM raw_lines GROUP BY 1, 2""",
    "c5_order_lines": "SELECT * FROM d_lines",
    "c5_order_lines_aisle": "SELECT * FROM d_lines",
    "a1_top_products": TOP.format(by="total_purchases"),
    "a1_top_aisles": TOP.format(by="total_purchases"),
    "a2_volume_by_day_hour": """SELECT order_dow, order_hour_of_day,
  CAST(count(DISTINCT order_id) AS BIGINT) AS order_volume FROM d_orders GROUP BY 1, 2""",
    "a3_retention": f"""SELECT total_orders, CAST(count(user_id) AS BIGINT) AS customer_count,
  round(avg(avg_days_between_orders), 2) AS mean_days_between_orders
FROM ({SUMMARY}) GROUP BY 1""",
    "a4_customer_summary": f"""SELECT * REPLACE (round(avg_days_between_orders, 4)
  AS avg_days_between_orders, round(avg_order_hour, 4) AS avg_order_hour) FROM ({SUMMARY})""",
    "a5_order_baskets": """SELECT o.order_id, o.user_id, o.order_number, order_dow,
  order_hour_of_day, days_since_prior_order, CAST(count(product_id) AS BIGINT) AS basket_size,
  CAST(sum(reordered) AS BIGINT) AS reordered_count,
  round(CAST(sum(reordered) AS DOUBLE) / count(product_id), 4) AS reorder_ratio
FROM d_orders o JOIN d_lines l ON o.order_id = l.order_id GROUP BY 1, 2, 3, 4, 5, 6""",
    "e1_peaks": f"""SELECT order_dow AS peak_dow, {DOW} AS peak_day, (
  SELECT order_hour_of_day FROM d_orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_hour
FROM d_orders GROUP BY order_dow ORDER BY count(*) DESC, order_dow LIMIT 1""",
    "e2_orders_by_weekday": f"""SELECT order_dow, {DOW} AS dow_name,
  CAST(count(*) AS BIGINT) AS order_count FROM d_orders GROUP BY 1""",
    "e3_orders_by_hour": """SELECT order_hour_of_day, CAST(count(*) AS BIGINT) AS order_count
FROM d_orders GROUP BY 1""",
    "e4_day_hour_matrix": f"SELECT {DOW} AS dow_name, {HOURS} FROM d_orders GROUP BY order_dow",
    "e5_repurchase_interval": """SELECT round(avg(days_since_prior_order), 2) AS mean_interval,
  quantile_cont(days_since_prior_order, 0.5) AS median_interval,
  round(count(*) FILTER (days_since_prior_order = 7) / CAST(count(*) AS DOUBLE) * 100, 2)
    AS weekly_pct,
  round(count(*) FILTER (days_since_prior_order = 30) / CAST(count(*) AS DOUBLE) * 100, 2)
    AS monthly_pct FROM d_orders WHERE is_first_order = 0""",
    "e6_interval_histogram": """SELECT CAST(days_since_prior_order AS BIGINT) AS days,
  CAST(count(*) AS BIGINT) AS order_count FROM d_orders WHERE is_first_order = 0 GROUP BY 1""",
    "e7_basket_size_stats": f"""SELECT round(avg(n), 2) AS mean_basket_size,
  CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median_basket_size,
  CAST(quantile_cont(n, 0.75) AS DOUBLE) AS p75_basket_size,
  CAST(quantile_cont(n, 0.95) AS DOUBLE) AS p95_basket_size FROM {SIZES}""",
    "e8_basket_size_histogram": f"""SELECT bin, round(1.0 + bin * (39.0 / 40), 4) AS bin_start,
  CAST(count(*) AS BIGINT) AS frequency FROM (
  SELECT CAST(least(floor((n - 1) / (CAST(39 AS DOUBLE) / 40)), 39) AS BIGINT) AS bin
  FROM {SIZES} WHERE n BETWEEN 1 AND 40) GROUP BY 1""",
    "e9_reorder_breakdown": """SELECT CASE reordered WHEN 1 THEN 'Reordered Item'
  ELSE 'First-Time Purchase' END AS purchase_type, CAST(count(*) AS BIGINT) AS line_count,
  round(count(*) / CAST((SELECT count(*) FROM d_lines) AS DOUBLE) * 100, 2) AS share_pct
FROM d_lines GROUP BY reordered""",
    "e10_customer_stats": """SELECT CAST(count(*) AS BIGINT) AS customer_count,
  round(avg(total_orders), 2) AS mean_orders,
  CAST(quantile_cont(total_orders, 0.5) AS DOUBLE) AS median_orders,
  max(total_orders) AS max_orders FROM d_customers""",
    "e11_lifetime_histogram": """SELECT bin, round(lo + bin * w, 4) AS bin_start,
  CAST(count(*) AS BIGINT) AS frequency FROM (
  SELECT lo, w, CAST(least(floor((total_orders - lo) / w), 49) AS BIGINT) AS bin
  FROM d_customers, (SELECT CAST(min(total_orders) AS DOUBLE) AS lo,
    (max(total_orders) - min(total_orders)) / CAST(50 AS DOUBLE) AS w FROM d_customers))
GROUP BY 1, 2""",
    "e12_bestsellers": """SELECT product_id, product_name, department,
  total_purchases AS total_orders,
  round(CAST(total_reorders AS DOUBLE) / total_purchases * 100, 2) AS reorder_rate_pct
FROM counts JOIN d_products USING (product_id) JOIN d_departments USING (department_id)
ORDER BY total_purchases DESC, product_id LIMIT 10""",
    "e13_departments": """SELECT department, CAST(sum(total_purchases) AS BIGINT) AS total_volume,
  round(avg(CAST(total_reorders AS DOUBLE) / total_purchases), 4) AS mean_reorder_rate
FROM counts JOIN d_products USING (product_id) JOIN d_departments USING (department_id)
GROUP BY 1""",
    "e14_reorder_by_order_number": """SELECT order_number, CAST(count(*) AS BIGINT) AS line_count,
  round(avg(reordered), 4) AS reorder_rate FROM d_lines WHERE order_number <= 60 GROUP BY 1""",
    "e15_user_cadence": """SELECT user_id, round(avg(days_since_prior_order), 4) AS mean_interval,
  round(stddev_samp(days_since_prior_order), 4) AS std_interval,
  CAST(count(*) AS BIGINT) AS order_count
FROM d_orders WHERE is_first_order = 0 GROUP BY 1 HAVING count(*) > 1""",
    "e16_department_diversity": """SELECT departments, CAST(count(*) AS BIGINT) AS customer_count
FROM (SELECT user_id, CAST(count(DISTINCT department_id) AS BIGINT) AS departments
  FROM d_lines JOIN d_products USING (product_id) GROUP BY 1) GROUP BY 1""",
    "e17_reorder_by_cart_position": """SELECT add_to_cart_order, CAST(count(*) AS BIGINT)
  AS line_count, round(avg(reordered), 4) AS reorder_rate
FROM d_lines WHERE add_to_cart_order <= 25 GROUP BY 1""",
    "e18_top_pairs": """, top50 AS (
  SELECT product_id FROM counts ORDER BY total_purchases DESC, product_id LIMIT 50)
SELECT x.product_name || ' + ' || y.product_name AS pair_label, source, target, co_occurrence
FROM (SELECT a.product_id AS source, b.product_id AS target,
    CAST(count(*) AS BIGINT) AS co_occurrence
  FROM d_lines a JOIN d_lines b ON a.order_id = b.order_id AND a.product_id < b.product_id
  WHERE a.product_id IN (SELECT * FROM top50) AND b.product_id IN (SELECT * FROM top50)
  GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10)
JOIN d_products x ON x.product_id = source JOIN d_products y ON y.product_id = target""",
    "e19_feature_correlation": _union([
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 4) AS correlation "
        "FROM cf" for a in CORRELATED for b in CORRELATED]),
    "e20_class_balance": """SELECT target, CAST(count(*) AS BIGINT) AS row_count,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM upf), 4) AS share FROM upf GROUP BY 1""",
    "e20_order_rate_boxplot": _boxplot(),
    "f1_history": """SELECT reordered, CAST(count(*) AS BIGINT) AS line_count,
  max(order_number) AS max_order_number FROM d_lines WHERE eval_set = 'prior' GROUP BY 1""",
    "f2_product_features": "SELECT * FROM pf",
    "f2_aisle_features": "SELECT * FROM pf",
    "f3_customer_order_stats": CF_ROUNDED + """(SELECT o.*, user_preferred_dow,
  user_preferred_hour FROM cf_orders o JOIN cf_dow USING (user_id) JOIN cf_hour USING (user_id))""",
    "f3_order_stats_repeat_only": """SELECT o.user_id, user_total_orders,
  round(g.m, 4) AS user_avg_order_interval, coalesce(round(g.s, 4), 0.0)
  AS user_std_order_interval, user_preferred_dow, user_preferred_hour, user_days_since_last_order
FROM cf_orders o JOIN cf_dow USING (user_id) JOIN cf_hour USING (user_id)
LEFT JOIN (SELECT user_id, avg(days_since_prior_order) AS m,
  stddev_samp(days_since_prior_order) AS s FROM d_orders
  WHERE eval_set = 'prior' AND order_number > 1 GROUP BY 1) g ON g.user_id = o.user_id""",
    "f4_customer_item_stats": ITEM_STATS,
    "f5_customer_features": CF_ROUNDED + "cf",
    "f6_pair_stats": "SELECT * FROM ups",
    "f7_f8_pair_features": "SELECT * FROM upf",
    "f8_pair_features_product": "SELECT * FROM upf",
    "f9_cohort": "SELECT * FROM cohort",
    "g1_scaled_features": "SELECT user_id, " + ", ".join(
        f"round((coalesce({c}, 0) - (SELECT avg(coalesce({c}, 0)) FROM cf)) / "
        f"(SELECT stddev_pop(coalesce({c}, 0)) FROM cf), 4) AS z_{c}" for c in FEATURES)
    + " FROM cf",
    "g5_cluster_profile": _union([
        f"""SELECT cluster, '{c}' AS feature, round(avg({c}), 2) AS mean,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS median,
  CAST(count({c}) AS BIGINT) AS customer_count FROM labelled GROUP BY 1""" for c in FEATURES]),
    "g6_personas": "SELECT user_id, cluster, segment_name FROM segs",
    "g7_segment_summary": """SELECT cluster, segment_name,
  CAST(count(*) AS BIGINT) AS customer_count,
  round(count(*) / CAST((SELECT count(*) FROM segs) AS DOUBLE) * 100, 2) AS customer_pct,
  round(avg(user_total_orders), 2) AS avg_lifetime_orders,
  round(avg(user_avg_order_interval), 2) AS avg_order_interval_days,
  round(avg(user_avg_basket_size), 2) AS avg_basket_size,
  round(avg(user_reorder_rate) * 100, 2) AS avg_reorder_rate,
  round(avg(user_unique_departments), 2) AS avg_departments_explored,
  round(avg(user_days_since_last_order), 2) AS avg_recency_days FROM segs GROUP BY 1, 2""",
    "p1_training_matrix": """SELECT * REPLACE (round(user_avg_order_interval, 4)
  AS user_avg_order_interval) FROM matrix""",
    "p2_sample": """SELECT user_id, product_id, target FROM hashed
ORDER BY pair_hash, user_id, product_id LIMIT 20000""",
    "p3_split": """SELECT CASE WHEN user_hash < 0.8 THEN 'train' ELSE 'validation' END AS side,
  CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT user_id) AS BIGINT) AS user_count,
  CAST(sum(target) AS BIGINT) AS positives FROM hashed GROUP BY 1""",
    "p7_p8_ranking_metrics": "SELECT model, roc_auc, pr_auc FROM auc JOIN ap USING (model)",
    "p9_threshold_metrics": _thresholds([0.20]),
    "p10_threshold_sweep": "SELECT model, threshold, precision, recall, f1_score FROM ("
                           + _thresholds([0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50]) + ")",
    "p12_leaderboard_fixed": FIXED_BOARD,
    "t1_timeline": "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM dated",
    "t2_daily_volume": "SELECT * REPLACE (CAST(ds AS VARCHAR) AS ds) FROM vol",
    "t2_real_dates": "SELECT * REPLACE (CAST(ds AS VARCHAR) AS ds) FROM realvol",
    "t3_filled_days": "SELECT * REPLACE (CAST(ds AS VARCHAR) AS ds) FROM real_f",
    "t4_holdout": """SELECT series_key, CAST(is_holdout AS BIGINT) AS is_holdout,
  CAST(min(ds) AS VARCHAR) AS first_day, CAST(max(ds) AS VARCHAR) AS last_day,
  CAST(count(*) AS BIGINT) AS days,
  CAST(sum(y) AS BIGINT) AS volume FROM vol_h GROUP BY 1, 2""",
    "t5_average_backtest": "SELECT * REPLACE (round(predicted, 4) AS predicted, "
                           "CAST(ds AS VARCHAR) AS ds) FROM sma",
    "t6_smoothing_fixed": _smoothing("vol_h"),
    "t6_smoothing_forecast": SMOOTHED + "SELECT * FROM fc",
    "t7_arima": _arima("vol_h", "NOT is_holdout") + """
SELECT series_key, 'Seasonal ARIMA' AS model, CAST(ds AS VARCHAR) AS ds, CAST(y AS DOUBLE) AS y,
  round(value, 3) AS predicted
FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ds) AS h FROM vol_h
  WHERE is_holdout) JOIN path USING (series_key, h) WHERE kind = 'mean'""",
    "t12_forecast": _arima_ahead("dept_f") + "SELECT *, CAST(NULL AS VARCHAR) AS reason FROM fcs",
    "t8_forecast": FORECAST + "SELECT * FROM fc",
    "t12_product_series": """, prodvol AS (
  SELECT product_id, order_date AS ds, count(DISTINCT l.order_id) AS y
  FROM d_lines l JOIN d_orders o ON l.order_id = o.order_id GROUP BY 1, 2)
SELECT CAST(product_id AS VARCHAR) AS series_key, CAST(min(ds) AS VARCHAR) AS first_day,
  CAST((SELECT max(ds) FROM prodvol) - min(ds) + 1 AS BIGINT) AS days,
  CAST(sum(y) AS BIGINT) AS volume, CAST(count(*) AS BIGINT) AS active_days,
  CAST(max(y) AS BIGINT) AS largest_day,
  CASE WHEN (SELECT max(ds) FROM prodvol) - min(ds) + 1 < 28 THEN 'fewer than 28 days' END AS reason
FROM prodvol GROUP BY 1""",
    "t12_smoothing_aisles": _smoothing("aisle_h"),
    "t9_average_errors": _errors("sma"),
    "t11_horizon": HORIZON.format(days=14),
    "t12_department_days": "SELECT * REPLACE (CAST(ds AS VARCHAR) AS ds) FROM dept_f",
    "t12_average_errors": _errors("dept_sma"),
    "h1_nodes": _union([
        "SELECT 'customer' AS table_name, CAST(count(*) AS BIGINT) AS row_count "
        "FROM segs", "SELECT 'product', count(*) FROM pf", "SELECT 'aisle', count(*) FROM d_aisles",
        "SELECT 'department', count(*) FROM d_departments"]),
    "h2_taxonomy_edges": """SELECT product_id AS source, aisle_id AS target, 'BELONGS_TO' AS type
FROM d_products UNION ALL SELECT DISTINCT aisle_id, department_id, 'IN_DEPARTMENT'
FROM d_products""",
    "h3_bought_edges": "SELECT * FROM bought",
    "h4_co_purchase": "SELECT * FROM edges",
    "h4_co_purchase_product": "SELECT * FROM edges",
    "h5_bought_together": """SELECT s.product_name AS source_product,
  t.product_name AS recommended_product, co_occurrence AS times_co_purchased,
  CAST(rank AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY co_occurrence DESC, target) AS rank
  FROM edges) e JOIN d_products s ON s.product_id = source
JOIN d_products t ON t.product_id = target WHERE rank <= 10""",
    "h6_similar_customers": NEAR,
    "h6_recommendations": f""", near AS ({NEAR})
SELECT user_id, product_id, affinity_score, recommended_product, product_reorder_rate,
  CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY affinity_score DESC,
    product_reorder_rate DESC, product_id) AS rank FROM (
    SELECT n.user_id, b.target AS product_id, CAST(count(*) AS BIGINT) AS affinity_score,
      any_value(p.product_name) AS recommended_product,
      any_value(p.prod_reorder_rate) AS product_reorder_rate
    FROM near n JOIN bought b ON b.source = n.other JOIN pf p ON p.product_id = b.target
    WHERE NOT EXISTS (SELECT 1 FROM bought s WHERE s.source = n.user_id AND s.target = b.target)
    GROUP BY 1, 2)) WHERE rank <= 10""",
    "h7_segment_departments": """SELECT segment_name, department, total_purchases,
  CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY segment_name
    ORDER BY total_purchases DESC, department) AS rank FROM (
    SELECT segment_name, department, CAST(count(*) AS BIGINT) AS total_purchases
    FROM bought JOIN segs ON user_id = source JOIN d_products ON product_id = target
    JOIN d_departments USING (department_id) GROUP BY 1, 2)) WHERE rank <= 8""",
    "h8_neighbourhood": """SELECT p.product_id, p.product_name, aisle, department,
  coalesce(items, '') AS top_affinity_items
FROM d_products p JOIN d_aisles USING (aisle_id) JOIN d_departments USING (department_id)
LEFT JOIN (SELECT source, string_agg(product_name, ' | ' ORDER BY rank) AS items FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY co_occurrence DESC, target) AS rank
  FROM edges) e JOIN d_products t ON t.product_id = target WHERE rank <= 5 GROUP BY 1) a
ON a.source = p.product_id""",
    "h9_upsert_edges": """SELECT source, target, type,
  order_count, reorders_count FROM bought""",
    "h9_upsert_nodes": """SELECT product_id, product_name AS name,
  prod_reorder_rate AS reorder_rate, coalesce(total_purchases, prod_total_orders) AS total_orders
FROM pf LEFT JOIN counts USING (product_id)""",
    "r1_profiles": f"""SELECT user_id, cluster AS segment_id, segment_name AS segment_persona,
  user_total_orders AS total_orders,
  round(user_avg_order_interval, 1) AS avg_order_interval_days,
  round(user_avg_basket_size, 1) AS avg_basket_size,
  CAST(round(CAST(user_reorder_rate AS DECIMAL(12, 4)) * 100, 1) AS DOUBLE) AS reorder_rate_pct,
  user_unique_departments AS distinct_departments,
  round(user_days_since_last_order, 1) AS days_since_last_order,
  {_case('segment_name', STRATEGIES, DEFAULT_STRATEGY)}
    AS retention_action_strategy FROM segs""",
    "r2_reorder_list": R2.format(threshold=0.1) + " WHERE rank IS NOT NULL",
    "r2_counts": R2.format(threshold=0.12).replace(
        "SELECT s.user_id,", "SELECT DISTINCT user_id, customer_segment, recommendations_count "
        "FROM (SELECT s.user_id,", 1) + ")",
    "r3_bought_together": _bought_together(5),
    "r4_forecast_response": HORIZON.format(days=30),
    "r4_daily_forecast": FORECAST + "SELECT row_number() OVER (ORDER BY forecast_date) AS day, "
                                    "* FROM fc",
    "r5_named_products": """SELECT row_number() OVER (ORDER BY total_purchases DESC, product_id)
  AS position, product_id, product_name FROM counts JOIN d_products USING (product_id)
ORDER BY total_purchases DESC, product_id LIMIT 8""",
    "r6_inventory": """SELECT CAST((SELECT count(*) FROM segs) AS BIGINT) AS customers_indexed,
  CAST((SELECT count(*) FROM pf) AS BIGINT) AS products_indexed""",
    "r7_affinity_tiers": f"""SELECT *, CASE WHEN times_co_purchased > 30 THEN 'High Affinity'
  ELSE 'Medium Affinity' END AS tier FROM ({_bought_together(6)})""",
    "r7_bundles": f"""SELECT source_product_id, any_value(source_product_name) || ' + '
  || string_agg(product_name, ' + ' ORDER BY rank) AS bundle,
  CASE WHEN max(times_co_purchased) > 30 THEN 'High Affinity' ELSE 'Medium Affinity' END
    AS top_tier FROM ({_bought_together(6)}) WHERE rank <= 2 GROUP BY 1""",
    "r8_descriptions": "SELECT segment_name, CASE " + " ".join(
        f"WHEN contains(segment_name, '{w}') THEN '{t}'"
        for w, t in DESCRIPTIONS.items())
    + f" ELSE '{OTHER_DESCRIPTION}' END AS description FROM (SELECT DISTINCT segment_name "
      "FROM segs)",
    "b1_customer_feed": CF_ROUNDED + "segs",
    "b2_product_intelligence": """SELECT pf.*, department, aisle FROM pf
JOIN d_departments USING (department_id) JOIN d_aisles USING (aisle_id)""",
    "b3_forecast_feed": FORECAST + "SELECT * FROM fc",
    "b4_cross_sell": """SELECT s.product_name AS source_product,
  t.product_name AS recommended_product, co_occurrence AS times_co_purchased
FROM (SELECT * FROM edges ORDER BY co_occurrence DESC, source, target LIMIT 250)
JOIN d_products s ON s.product_id = source JOIN d_products t ON t.product_id = target""",
    "b4_cross_sell_by_id": """SELECT s.product_name AS source_product,
  t.product_name AS recommended_product, co_occurrence AS times_co_purchased
FROM (SELECT * FROM edges ORDER BY source, target LIMIT 250)
JOIN d_products s ON s.product_id = source JOIN d_products t ON t.product_id = target""",
    "b5_kpis": KPIS,
    "b6_measures": FORECAST + """SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS total_customers,
  round(avg(user_avg_basket_size), 4) AS avg_basket_size,
  round(avg(user_reorder_rate) * 100, 4) AS platform_reorder_rate_pct,
  round(count(*) FILTER (segment_name = 'High-Value Frequent Loyalists')
    / CAST(count(*) AS DOUBLE) * 100, 4) AS high_value_loyalists_pct,
  CAST((SELECT sum(predicted_demand) FROM fc) AS BIGINT) AS total_projected_orders FROM segs""",
    "b6_line_reorder_rate": """SELECT round(avg(reordered) * 100, 4) AS line_reorder_rate_pct
FROM d_lines""",
    "b7_segment_distribution": """SELECT segment_name, CAST(count(*) AS BIGINT) AS customer_count,
  round(count(*) / CAST((SELECT count(*) FROM segs) AS DOUBLE) * 100, 2) AS customer_pct
FROM segs GROUP BY 1""",
    "b8_top_departments": """SELECT department, CAST(count(*) AS BIGINT) AS order_lines,
  round(count(*) / CAST((SELECT count(*) FROM d_lines) AS DOUBLE) * 100, 2) AS share_pct
FROM d_lines JOIN d_products USING (product_id) JOIN d_departments USING (department_id)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "b9_segment_diversity": """SELECT segment_name, round(avg(user_avg_basket_size), 4)
  AS avg_basket_size, round(avg(user_unique_departments), 4) AS avg_departments
FROM segs GROUP BY 1""",
    "b10_high_value": """SELECT user_id, segment_name, user_total_orders, user_avg_basket_size,
  user_reorder_rate FROM segs WHERE segment_name = 'High-Value Frequent Loyalists'
ORDER BY user_total_orders DESC, user_id LIMIT 100""",
    "b11_most_reordered": TOP.format(by="total_reorders"),
    "b12_demand_line": FORECAST + """SELECT CAST(day AS VARCHAR) AS day, kind, volume, round(sum(volume) OVER (
  PARTITION BY kind ORDER BY day), 4) AS cumulative_volume FROM (
  SELECT ds AS day, 'actual' AS kind, CAST(y AS DOUBLE) AS volume FROM vol_f
  UNION ALL SELECT CAST(forecast_date AS DATE), 'forecast', CAST(predicted_demand AS DOUBLE)
  FROM fc)""",
    "b12_peak_day": FORECAST + """SELECT forecast_date AS peak_day, predicted_demand AS peak_demand,
  CAST((SELECT sum(predicted_demand) FROM fc) AS BIGINT) AS total_volume
FROM fc ORDER BY predicted_demand DESC, forecast_date LIMIT 1""",
    "b13_scorecard": f""", board AS ({FIXED_BOARD}), errs AS ({_errors('sma')})
SELECT 'classification' AS kind, model, metric, value FROM board UNPIVOT (
  value FOR metric IN (roc_auc, pr_auc, precision, recall, f1_score))
UNION ALL SELECT 'forecast', model, metric, value FROM errs UNPIVOT (
  value FOR metric IN (mae, rmse, mape))""",
}


def all_sql():
    """SQL per query name, each with the derived tables of its grain."""
    made = {grain: prelude(grain) for grain in ("product", "aisle")}
    return {name: made[CATALOGUE[name][0]] + sql for name, sql in SQL.items()}
