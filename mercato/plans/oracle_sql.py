"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement starts from the test-table binding (``oracle_binding``) and derives its result
in its own way, in whole cents: the questions are answered from four small relations (item
lines in cents, delivered orders, their lines, their buyers), shares from scalar totals,
running totals and ranks by counting what stands ahead, buckets by arithmetic on positions.
Key lists, thresholds and the rounding rule are written out here, not taken from the library.
"""

from __future__ import annotations

from . import oracle_forecast
from .oracle_binding import hud, with_binding


def pct(num: str, den: str, digits: int = 2) -> str:
    return hud(f"(CAST({num} AS HUGEINT) * 100)", den, digits)


def money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100.0"


ORACLE: dict[str, str] = {}


def _q(name: str, ctes: str, select: str) -> None:
    ORACLE[name] = with_binding(ctes, select)


# ---------------------------------------------------------------- star tables
_q("dim_date", """
bounds_ AS (SELECT CAST(min(order_purchase_timestamp) AS DATE) AS s, CAST(max(order_purchase_timestamp) AS DATE) AS e
            FROM fact_orders),
days_ AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds_)
""", """
SELECT date, CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
       dayname(date) AS weekday, isodow(date) IN (6, 7) AS is_weekend
FROM days_""")

_q("dim_customers", "", "SELECT * FROM dim_customers")
_q("dim_products", "", """
SELECT product_id, product_category_name_english, product_category_name_pt,
       CAST(product_name_length AS BIGINT) AS product_name_length,
       CAST(product_description_length AS BIGINT) AS product_description_length,
       CAST(product_photos_qty AS BIGINT) AS product_photos_qty,
       CAST(product_weight_g AS DOUBLE) AS product_weight_g,
       CAST(product_length_cm AS DOUBLE) AS product_length_cm,
       CAST(product_height_cm AS DOUBLE) AS product_height_cm,
       CAST(product_width_cm AS DOUBLE) AS product_width_cm
FROM dim_products""")
_q("dim_sellers", "", "SELECT * FROM dim_sellers")
_q("fact_orders", "", """
SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
       order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
       CAST(delivery_days AS BIGINT) AS delivery_days, is_late
FROM fact_orders""")
_q("fact_order_items", "", """
SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id,
       shipping_limit_date, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
FROM fact_order_items""")
_q("order_payments", "", """
SELECT order_id, CAST(payment_sequential AS BIGINT) AS payment_sequential, payment_type,
       CAST(payment_installments AS BIGINT) AS payment_installments,
       CAST(payment_value AS DOUBLE) AS payment_value
FROM order_payments""")
_q("order_reviews", "", """
SELECT review_id, order_id, CAST(review_score AS BIGINT) AS review_score, review_comment_title,
       review_comment_message, review_creation_date, review_answer_timestamp
FROM order_reviews""")
_q("geolocation", "", "SELECT * FROM geolocation")

# ---------------------------------------------------------------- analysis
#: line_: item lines in cents; done_: delivered orders, their month counted from year 0;
#: sold_: delivered lines; buyer_: delivered orders with person and state.
_BASE = """
line_ AS (
    SELECT order_id, order_item_id, product_id, seller_id,
           CAST(price * 100 AS BIGINT) + CAST(freight_value * 100 AS BIGINT) AS c
    FROM fact_order_items),
done_ AS (
    SELECT *, year(order_purchase_timestamp) * 12 + month(order_purchase_timestamp) - 1 AS ym
    FROM fact_orders WHERE order_status = 'delivered'),
sold_ AS (SELECT line_.*, ym, customer_id, order_purchase_timestamp AS bought FROM done_ JOIN line_ USING (order_id)),
buyer_ AS (SELECT done_.*, customer_unique_id AS person, customer_state AS state FROM done_ JOIN dim_customers USING (customer_id))
"""
_MONTH = "make_date({0} // 12, {0} % 12 + 1, 1)".format

_q("monthly_revenue_mom", _BASE + """,
turn_ AS (SELECT ym, sum(c) AS c, row_number() OVER (ORDER BY ym) AS at FROM sold_ GROUP BY ym)
""", f"""
SELECT {_MONTH('now.ym')} AS month, {money('now.c')} AS revenue,
       {hud('(now.c - old.c) * 100', 'old.c', 1)} AS mom_growth_pct
FROM turn_ now LEFT JOIN turn_ old ON old.at + 1 = now.at""")

_q("aov_trend", _BASE, f"""
SELECT {_MONTH('ym')} AS month, count(DISTINCT order_id) AS orders,
       {hud('sum(c)', 'count(DISTINCT order_id) * 100', 2)} AS aov
FROM sold_ GROUP BY ym""")

_q("category_pareto", _BASE + """,
earned_ AS (SELECT ifnull(product_category_name_english, 'unknown') AS category, sum(c) AS c
            FROM sold_ JOIN dim_products USING (product_id) GROUP BY category),
upto_ AS (SELECT a.category, any_value(a.c) AS c, sum(b.c) AS reached
          FROM earned_ a JOIN earned_ b ON b.c >= a.c GROUP BY a.category)
""", f"""
SELECT category, {money('c')} AS revenue, {pct('c', '(SELECT sum(c) FROM earned_)')} AS revenue_share_pct,
       {pct('reached', '(SELECT sum(c) FROM earned_)')} AS cumulative_share_pct
FROM upto_""")

_q("revenue_by_state", _BASE + """,
spent_ AS (SELECT order_id, sum(c) AS c FROM line_ GROUP BY order_id),
per_state_ AS (SELECT state, count(*) AS orders, sum(c) AS c FROM buyer_ JOIN spent_ USING (order_id) GROUP BY state)
""", f"""
SELECT state, orders, {money('c')} AS revenue, {pct('c', '(SELECT sum(c) FROM per_state_)')} AS revenue_share_pct
FROM per_state_""")

_q("payment_mix", "", f"""
SELECT payment_type, count(*) AS payment_records, {pct('count(*)', '(SELECT count(*) FROM order_payments)')} AS share_pct,
       {hud('sum(payment_installments)', 'count(payment_installments)', 2)} AS avg_installments,
       {money('sum(CAST(payment_value * 100 AS BIGINT))')} AS total_payment_value
FROM order_payments GROUP BY payment_type""")

_q("seller_concentration", _BASE + """,
earned_ AS (SELECT seller_id, sum(c) AS c FROM sold_ GROUP BY seller_id),
ahead_ AS (SELECT a.seller_id, any_value(a.c) AS c, count(*) AS place, sum(b.c) AS reached
           FROM earned_ a JOIN earned_ b ON b.c > a.c OR (b.c = a.c AND b.seller_id <= a.seller_id)
           GROUP BY a.seller_id)
""", f"""
SELECT seller_id, {money('c')} AS revenue, place AS revenue_rank,
       {pct('reached', '(SELECT sum(c) FROM earned_)')} AS cumulative_share_pct
FROM ahead_ WHERE place <= 10""")

_q("order_status_funnel", "", f"""
SELECT order_status, count(*) AS orders, {pct('count(*)', '(SELECT count(*) FROM fact_orders)')} AS share_pct
FROM fact_orders GROUP BY order_status""")

_q("delivery_days_distribution", _BASE, """
SELECT CAST(delivery_days AS BIGINT) AS delivery_days, count(delivery_days) AS orders
FROM done_ GROUP BY ALL HAVING count(delivery_days) > 0""")

_q("late_pct_by_month", _BASE, f"""
SELECT {_MONTH('ym')} AS month, count(*) AS delivered_orders, CAST(count_if(is_late) AS BIGINT) AS late_orders,
       {pct('count_if(is_late)', 'count(*)')} AS late_pct
FROM done_ GROUP BY ym""")

_q("late_pct_by_state", _BASE, f"""
SELECT state, count(*) AS delivered_orders, CAST(count_if(is_late) AS BIGINT) AS late_orders,
       {pct('count_if(is_late)', 'count(*)')} AS late_pct
FROM buyer_ GROUP BY state HAVING count(*) >= 30""")

#: Delivered orders of known lateness with their review's score.
_SCORED = _BASE + """,
scored_ AS (SELECT d.is_late, r.review_score AS score FROM order_reviews r JOIN done_ d ON d.order_id = r.order_id
            WHERE d.is_late IS NOT NULL)
"""
_q("late_vs_review", _SCORED, f"""
SELECT is_late, count(*) AS reviewed_orders, {hud('sum(score)', 'count(score)', 2)} AS avg_review_score,
       CAST(median(score) AS DOUBLE) AS median_review_score, {pct('count_if(score <= 2)', 'count(*)')} AS pct_1_2_star
FROM scored_ GROUP BY is_late""")

#: Each person's list of active months; its least is the cohort, distances to it the offsets.
_COHORT = _BASE + """,
seen_ AS (SELECT person, list(DISTINCT ym) AS months FROM buyer_ GROUP BY person),
step_ AS (SELECT person, list_min(months) AS ym, unnest(months) - list_min(months) AS gap FROM seen_),
active_ AS (SELECT ym, gap, count(person) AS people FROM step_ GROUP BY ym, gap)
"""
_q("cohort_retention", _COHORT, f"""
SELECT {_MONTH('ym')} AS cohort, CAST(gap AS BIGINT) AS month_offset, people AS active_customers FROM active_""")

_q("repeat_purchase_rate", _BASE + """,
times_ AS (SELECT n, count(*) AS people FROM (SELECT count(*) AS n FROM buyer_ GROUP BY person) GROUP BY n)
""", f"""
SELECT CAST(ifnull(sum(people), 0) AS BIGINT) AS total_customers,
       CAST(ifnull(sum(people) FILTER (WHERE n > 1), 0) AS BIGINT) AS repeat_customers,
       {pct('ifnull(sum(people) FILTER (WHERE n > 1), 0)', 'ifnull(sum(people), 0)')} AS repeat_pct
FROM times_""")

#: Per person with items: last day, orders, cents; and the place from 0 by day and by money.
_RFM = _BASE + """,
spent_ AS (SELECT order_id, sum(c) AS c FROM line_ GROUP BY order_id),
rfm_ AS (SELECT person, max(CAST(order_purchase_timestamp AS DATE)) AS last_order, count(*) AS frequency, sum(c) AS c
         FROM buyer_ JOIN spent_ USING (order_id) GROUP BY person),
placed_ AS (SELECT *, least(frequency, 3) AS f_bucket, (SELECT count(*) FROM rfm_) AS n,
                   row_number() OVER (ORDER BY last_order NULLS LAST, person NULLS LAST) - 1 AS r_at,
                   row_number() OVER (ORDER BY c NULLS LAST, person NULLS LAST) - 1 AS m_at
            FROM rfm_)
"""


def _fifth(at: str) -> str:
    """Which of five parts the place falls in; the first n % 5 parts hold one row more."""
    return (f"CASE WHEN {at} < (n % 5) * (n // 5 + 1) THEN {at} // (n // 5 + 1) + 1 "
            f"ELSE ({at} - n % 5) // greatest(n // 5, 1) + 1 END")


_q("rfm_scores", _RFM, f"""
SELECT person AS customer_unique_id, {_fifth('r_at')} AS r_score, CAST(f_bucket AS BIGINT) AS f_bucket,
       {_fifth('m_at')} AS m_score
FROM placed_""")

_q("rfm_segment_share", _RFM, f"""
SELECT {_fifth('r_at')} AS r_score, CAST(f_bucket AS BIGINT) AS f_bucket, count(*) AS customers,
       {money('sum(c)')} AS segment_revenue, {pct('sum(c)', '(SELECT sum(c) FROM rfm_)')} AS revenue_share_pct
FROM placed_ GROUP BY ALL""")

#: Both sides of an order's money stacked: items count down, payments up.
_BALANCE = _BASE + """,
entry_ AS (SELECT order_id, c AS item, NULL AS paid FROM line_
           UNION ALL SELECT order_id, NULL, CAST(payment_value * 100 AS BIGINT) FROM order_payments),
balance_ AS (SELECT order_id, sum(item) AS item, sum(paid) AS paid FROM entry_
             WHERE order_id IN (SELECT order_id FROM fact_orders) GROUP BY order_id
             HAVING abs(sum(paid) - sum(item)) > 1)
"""
_q("items_vs_payments", _BALANCE, f"""
SELECT order_id, {money('item')} AS item_total, {money('paid')} AS payment_total, {money('(paid - item)')} AS diff
FROM balance_""")

_q("duplicate_review_orders", "", """
SELECT CAST(count_if(nth = 2) AS BIGINT) AS orders_with_multiple_reviews
FROM (SELECT row_number() OVER (PARTITION BY order_id) AS nth FROM stg_order_reviews)""")

_q("temporal_violations", "", """
SELECT CAST(count_if(order_delivered_carrier_date < order_approved_at) AS BIGINT) AS carrier_before_approved,
       CAST(count_if(order_delivered_customer_date < order_delivered_carrier_date) AS BIGINT) AS customer_before_carrier,
       count(order_delivered_customer_date) FILTER (WHERE order_status = 'canceled') AS canceled_with_delivery_date
FROM fact_orders""")

# ---------------------------------------------------------------- data quality
#: The staging tables, keys, parents, limits and column types of the checks, as SURVEY states them.
_STG = ["orders", "order_items", "order_payments", "order_reviews", "products", "product_category_translation", "sellers",
        "customers", "geolocation"]
_KEYS = {"orders": "order_id", "order_items": "order_id, order_item_id", "customers": "customer_id",
         "products": "product_id", "sellers": "seller_id"}
_PARENTS = [("order_items.order_id", "orders"), ("order_items.product_id", "products"), ("order_items.seller_id", "sellers"),
            ("orders.customer_id", "customers"), ("order_payments.order_id", "orders"), ("order_reviews.order_id", "orders")]
_STAR_OF = {"orders": "fact_orders", "order_items": "fact_order_items", "customers": "dim_customers",
            "products": "dim_products", "sellers": "dim_sellers"}
_NULL_RATES = [("orders", "order_approved_at", 5), ("orders", "order_delivered_customer_date", 100),
               ("order_reviews", "review_comment_title", 5000), ("order_reviews", "review_comment_message", 5000)]
_COUNTED = {"dim_customers": "customers", "dim_products": "products", "dim_sellers": "sellers", "fact_orders": "orders",
            "fact_order_items": "order_items", "order_payments": "order_payments"}
_COUNTED_KEYS = {"order_reviews": "order_id", "geolocation": "geolocation_zip_code_prefix"}
_CASTS = {
    "int": ["products.product_name_lenght", "products.product_description_lenght", "products.product_photos_qty",
            "order_items.order_item_id", "order_payments.payment_sequential", "order_payments.payment_installments",
            "order_reviews.review_score"],
    "decimal(18,4)": ["products.product_weight_g", "products.product_length_cm", "products.product_height_cm", "products.product_width_cm"],
    "decimal(18,2)": ["order_items.price", "order_items.freight_value", "order_payments.payment_value"],
    "decimal(24,16)": ["geolocation.geolocation_lat", "geolocation.geolocation_lng"],
    "timestamp_ntz": ["orders.order_purchase_timestamp", "orders.order_approved_at", "orders.order_delivered_carrier_date",
                      "orders.order_delivered_customer_date", "orders.order_estimated_delivery_date",
                      "order_items.shipping_limit_date", "order_reviews.review_creation_date",
                      "order_reviews.review_answer_timestamp"],
}
_BLOCKING, _LOGGED = "blocking", "logged"

_SQL_TYPE = {"int": "INTEGER", "decimal(18,2)": "DECIMAL(18,2)", "decimal(18,4)": "DECIMAL(18,4)",
             "decimal(24,16)": "DECIMAL(24,16)", "timestamp_ntz": "TIMESTAMP"}


def _row(check: str, table: str, detail: str, count: str, severity: str, src: str) -> str:
    detail = detail.replace("'", "''")
    return (f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{detail}' AS detail, "
            f"CAST({count} AS BIGINT) AS \"count\", '{severity}' AS severity FROM {src}")


def _union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _dup_src(table: str, key: str) -> str:
    return f"(SELECT count_if(nth = 2) AS n FROM (SELECT row_number() OVER (PARTITION BY {key}) AS nth FROM {table}))"


def _orphan_src(child: str, col: str, parent: str) -> str:
    return f"(SELECT count(*) - count_if({col} IN (SELECT {col} FROM {parent} WHERE {col} IS NOT NULL)) AS n FROM {child})"


_DQ_SQL: dict[str, str] = {}
_DQ_SQL["dq_row_counts"] = _union_sql([
    _row("row_count", t, f"no row staged for {t}", "CASE WHEN n > 0 THEN 0 ELSE 1 END", _BLOCKING,
         f"(SELECT count(*) AS n FROM stg_{t})") for t in _STG])
_DQ_SQL["dq_pk_duplicates"] = _union_sql([
    _row("pk_uniqueness", t, f"key ({key}) used by several staged rows", "n", _BLOCKING, _dup_src(f"stg_{t}", key))
    for t, key in _KEYS.items()])
_DQ_SQL["dq_orphan_fk"] = _union_sql([
    _row("referential_integrity", c, f"{cc} without a row in {p}", "n", _BLOCKING, _orphan_src(f"stg_{c}", cc, f"stg_{p}"))
    for c, cc, p in ((*x.split("."), p) for x, p in _PARENTS)])
_DQ_SQL["dq_domain"] = _union_sql([
    _row("domain", "order_reviews", "score outside 1 to 5", "n", _BLOCKING,
         "(SELECT count(*) FILTER (WHERE NOT (TRY_CAST(review_score AS INTEGER) BETWEEN 1 AND 5)) AS n "
         "FROM stg_order_reviews)"),
    _row("domain", "order_items", "negative price", "n", _BLOCKING,
         "(SELECT count(*) FILTER (WHERE TRY_CAST(price AS DECIMAL(18,2)) < 0) AS n FROM stg_order_items)"),
    _row("domain", "order_items", "negative freight", "n", _BLOCKING,
         "(SELECT count(*) FILTER (WHERE TRY_CAST(freight_value AS DECIMAL(18,2)) < 0) AS n FROM stg_order_items)"),
    _row("domain", "order_payments", "negative payment", "n", _BLOCKING,
         "(SELECT count(*) FILTER (WHERE TRY_CAST(payment_value AS DECIMAL(18,2)) < 0) AS n FROM stg_order_payments)"),
])
_TS = "TRY_CAST({} AS TIMESTAMP)".format
_DQ_SQL["dq_temporal"] = _union_sql([
    _row("temporal_sanity", "orders", "handed to the carrier before approval", "n", _LOGGED,
         f"(SELECT count(*) FILTER (WHERE {_TS('order_delivered_carrier_date')} < {_TS('order_approved_at')}) AS n FROM stg_orders)"),
    _row("temporal_sanity", "orders", "with the customer before the carrier", "n", _LOGGED,
         f"(SELECT count(*) FILTER (WHERE {_TS('order_delivered_customer_date')} < {_TS('order_delivered_carrier_date')}) AS n FROM stg_orders)"),
    _row("temporal_sanity", "orders", "canceled, yet handed to the customer", "n", _LOGGED,
         "(SELECT count(*) FILTER (WHERE order_status = 'canceled' AND order_delivered_customer_date IS NOT NULL) AS n FROM stg_orders)"),
])
_DQ_SQL["dq_null_policy"] = _union_sql([
    _row("null_policy", t, f"{c}: more than {bp} in 10000 missing",
         f"CASE WHEN nulls * 10000 > total * {bp} THEN nulls ELSE 0 END", _LOGGED,
         f"(SELECT count(*) AS total, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM stg_{t})")
    for t, c, bp in _NULL_RATES])
_DQ_SQL["dq_review_duplicates"] = _union_sql([
    _row("review_duplicates", "order_reviews", "review ids used by several rows", "n", _LOGGED,
         _dup_src("stg_order_reviews", "review_id")),
    _row("review_duplicates", "order_reviews", "orders reviewed several times", "n", _LOGGED,
         _dup_src("stg_order_reviews", "order_id")),
])
_DQ_SQL["dq_malformed_cast"] = _union_sql([
    _row("malformed_cast", t, f"{c}: text that {typ} cannot hold", "n", _BLOCKING,
         f"(SELECT count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {_SQL_TYPE[typ]}) IS NULL) AS n "
         f"FROM stg_{t})") for typ, cols in _CASTS.items() for t, c in (x.split(".") for x in cols)])


def _recon_src(name: str, src: str, col: str | None) -> str:
    b = "count(*)" if col is None else f"count(DISTINCT {col})"
    return f"(SELECT (SELECT count(*) FROM {name}) AS a, (SELECT {b} FROM stg_{src}) AS b)"


_DQ_SQL["dq_row_reconciliation"] = _union_sql([
    _row("row_reconciliation", n, f"rows of {n} and of its staged source differ in number",
         "CASE WHEN a = b THEN 0 ELSE 1 END", _BLOCKING, _recon_src(n, src, col))
    for n, src, col in [*((n, src, None) for n, src in _COUNTED.items()), *((n, n, col) for n, col in _COUNTED_KEYS.items())]])
_DQ_SQL["dq_output_orphan_fk"] = _union_sql([
    _row("referential_integrity", c, f"{cc} without a row in {p}", "n", _BLOCKING, _orphan_src(c, cc, p))
    for c, cc, p in ((_STAR_OF.get(t, t), cc, _STAR_OF[p]) for (t, cc), p in ((x.split("."), p) for x, p in _PARENTS))])
_DQ_SQL["dq_revenue_tieout"] = _row(
    "revenue_tie_out", "fact_order_items", "item revenue of the star is not that of staging",
    "CASE WHEN a IS NOT DISTINCT FROM b THEN 0 ELSE 1 END", _BLOCKING,
    "(SELECT (SELECT round(sum(price + freight_value), 2) FROM fact_order_items) AS a, "
    "(SELECT round(sum(TRY_CAST(price AS DECIMAL(18,2)) + TRY_CAST(freight_value AS DECIMAL(18,2))), 2) "
    "FROM stg_order_items) AS b)")
_DQ_SQL["dq_items_vs_payments"] = _row(
    "revenue_tie_out", "fact_order_items", "orders paid more or less than their items cost, by over one cent", "n", _LOGGED,
    "(SELECT count(*) AS n FROM balance_)")

for _k, _v in _DQ_SQL.items():
    _q(_k, _BALANCE if "balance_" in _v else "", _v)

_INPUT_SQL = _union_sql([f"({_DQ_SQL[k]})" for k in (
    "dq_row_counts", "dq_pk_duplicates", "dq_orphan_fk", "dq_domain", "dq_temporal",
    "dq_null_policy", "dq_review_duplicates", "dq_malformed_cast")])
_OUTPUT_SQL = _union_sql([f"({_DQ_SQL[k]})" for k in (
    "dq_row_reconciliation", "dq_output_orphan_fk", "dq_revenue_tieout", "dq_items_vs_payments")])

_REPORT_CTES = _BALANCE + f""",
in_ AS ({_INPUT_SQL}),
out_ AS ({_OUTPUT_SQL}),
rep_ AS (
    SELECT 'input' AS gate, * FROM in_ WHERE "count" <> 0
    UNION ALL
    SELECT 'output' AS gate, * FROM out_ WHERE "count" <> 0),
verdict_ AS (SELECT gate, count(*) FILTER (WHERE severity = 'blocking') = 0 AS passed FROM rep_ GROUP BY gate)
"""
_q("dq_report", _REPORT_CTES, """
SELECT r.gate, r."check", r."table", r.detail, r."count", r.severity, v.passed
FROM rep_ r JOIN verdict_ v USING (gate)""")
_q("dq_gate", _REPORT_CTES + """,
gates_ AS (SELECT * FROM (VALUES ('input'), ('output')) g(gate))
""", """
SELECT g.gate,
       count(r.severity) FILTER (WHERE r.severity = 'blocking') = 0 AS passed,
       count(r.severity) FILTER (WHERE r.severity = 'blocking') AS blocking_failures,
       count(r.severity) FILTER (WHERE r.severity = 'logged') AS logged_anomalies
FROM gates_ g LEFT JOIN rep_ r USING (gate)
GROUP BY g.gate""")


# ---------------------------------------------------------------- views, pivots, KPIs (W, P, K)
#: The view columns are fixed output names.
_VIEWS = _BASE + """,
vw_sales_ AS (
    SELECT s.order_id, s.order_item_id, s.product_id, s.seller_id, p.product_category_name_english,
           b.state AS customer_state, b.person AS customer_unique_id, s.bought AS order_purchase_timestamp,
           CAST(s.bought AS DATE) AS order_date, s.c, s.ym
    FROM buyer_ b JOIN sold_ s USING (order_id) JOIN dim_products p ON p.product_id = s.product_id),
vw_orders_ AS (
    SELECT b.* EXCLUDE (ym, person, state), b.state AS customer_state, CAST(b.order_purchase_timestamp AS DATE) AS order_date,
           (SELECT max(r.review_score) FROM order_reviews r WHERE r.order_id = b.order_id) AS review_score
    FROM buyer_ b),
basket_ AS (SELECT order_id, sum(c) AS c FROM line_ GROUP BY order_id),
vw_customers_ AS (
    SELECT person AS customer_unique_id, count(*) AS delivered_orders, sum(c) AS c, min(order_purchase_timestamp) AS first_order,
           max(order_purchase_timestamp) AS last_order, count(*) > 1 AS is_repeat
    FROM basket_ JOIN buyer_ USING (order_id) GROUP BY person),
vw_daily_orders_ AS (
    SELECT day AS order_date, sum(one) AS orders
    FROM (SELECT CAST(order_purchase_timestamp AS DATE) AS day, 1 AS one FROM fact_orders) GROUP BY day),
ext_ AS (
    SELECT order_id, ifnull(product_category_name_english, 'unknown') AS category, customer_state AS state, order_date,
           format('{:04d}-{:02d}', ym // 12, ym % 12 + 1) AS month, c, ym
    FROM vw_sales_)
"""

_q("vw_sales", _VIEWS, """
SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id,
       product_category_name_english, customer_state, customer_unique_id, order_purchase_timestamp,
       order_date, c / 100.0 AS line_revenue
FROM vw_sales_""")
_q("vw_orders", _VIEWS, """
SELECT order_id, customer_id, customer_state, order_purchase_timestamp, order_date,
       CAST(delivery_days AS BIGINT) AS delivery_days, is_late, order_estimated_delivery_date,
       order_delivered_customer_date, CAST(review_score AS BIGINT) AS review_score
FROM vw_orders_""")
_q("vw_customers", _VIEWS, """
SELECT customer_unique_id, delivered_orders, CAST(c AS DOUBLE) / 100.0 AS lifetime_revenue,
       first_order, last_order, is_repeat
FROM vw_customers_""")
_q("vw_daily_orders", _VIEWS, "SELECT order_date, CAST(orders AS BIGINT) AS orders FROM vw_daily_orders_")

_q("pivot_category_month", _VIEWS + """,
cell_ AS (SELECT category, month, sum(c) AS c FROM ext_ GROUP BY ALL),
grid_ AS (SELECT a.category, b.month, FALSE AS category_total, FALSE AS month_total, ifnull(any_value(cell_.c), 0) AS c
          FROM (SELECT DISTINCT category FROM cell_) a CROSS JOIN (SELECT DISTINCT month FROM cell_) b
          LEFT JOIN cell_ ON cell_.category = a.category AND cell_.month = b.month GROUP BY ALL)
""", """
SELECT category, month, category_total, month_total, CAST(c AS DOUBLE) / 100.0 AS revenue FROM grid_
UNION ALL SELECT category, NULL, FALSE, TRUE, CAST(sum(c) AS DOUBLE) / 100.0 FROM grid_ GROUP BY category
UNION ALL SELECT NULL, month, TRUE, FALSE, CAST(sum(c) AS DOUBLE) / 100.0 FROM grid_ GROUP BY month
UNION ALL SELECT NULL, NULL, TRUE, TRUE, CAST(sum(c) AS DOUBLE) / 100.0 FROM grid_ HAVING count(*) > 0""")

_q("pivot_state", _VIEWS, f"""
SELECT state, count(DISTINCT order_id) AS orders, {money('sum(c)')} AS revenue FROM ext_ GROUP BY state""")

_q("kpi_revenue", _VIEWS, f"""
SELECT {money('sum(c)')} AS total_revenue, count(DISTINCT order_id) AS total_orders,
       {hud('sum(c)', 'count(DISTINCT order_id) * 100', 2)} AS aov
FROM vw_sales_""")
_q("kpi_operations", _VIEWS, f"""
SELECT {pct('COUNT(*) FILTER (WHERE is_late)', 'COUNT(*)')} AS late_pct,
       median(delivery_days) AS median_delivery_days,
       {hud('SUM(review_score)', 'COUNT(review_score)', 2)} AS avg_review_score,
       {pct('COUNT(*) FILTER (WHERE review_score <= 2)', 'COUNT(review_score)')} AS pct_1_2_star
FROM vw_orders_""")
_q("kpi_repeat_pct", _VIEWS, f"""
SELECT CAST(count_if(is_repeat) AS BIGINT) AS repeat_customers, count(*) AS customers, {pct('count_if(is_repeat)', 'count(*)')} AS repeat_pct
FROM vw_customers_ WHERE customer_unique_id IS NOT NULL""")
_q("kpi_revenue_mom_calendar", _VIEWS + """,
spine_ AS (SELECT unnest(generate_series(min(ym), max(ym))) AS ym FROM vw_sales_),
m_ AS (SELECT spine_.ym, ifnull(sum(c), 0) AS c FROM spine_ LEFT JOIN vw_sales_ USING (ym) GROUP BY spine_.ym)
""", f"""
SELECT {_MONTH('b.ym')} AS month, {money('b.c')} AS revenue, {hud('(b.c - a.c) * 100', 'a.c', 1)} AS mom_growth_pct
FROM m_ b LEFT JOIN m_ a ON a.ym = b.ym - 1""")

_q("kpi_cohort_m1_m3", _COHORT + """,
wide_ AS (SELECT ym, max(people) FILTER (WHERE gap = 0) AS n0, ifnull(max(people) FILTER (WHERE gap = 1), 0) AS n1,
                 ifnull(max(people) FILTER (WHERE gap = 3), 0) AS n3 FROM active_ GROUP BY ym)
""", f"""
SELECT {_MONTH('ym')} AS cohort, n0 AS cohort_size, {pct('n1', 'n0')} AS m1_retention_pct, {pct('n3', 'n0')} AS m3_retention_pct
FROM wide_""")
_q("kpi_revenue_by_slicer", _VIEWS, f"""
SELECT state, category, {money('sum(c)')} AS total_revenue, count(DISTINCT order_id) AS total_orders,
       {hud('sum(c)', 'count(DISTINCT order_id) * 100', 2)} AS aov
FROM ext_ GROUP BY state, category""")

_q("kpi_revenue_sliced", _VIEWS, f"""
SELECT {money('sum(c)')} AS total_revenue, count(DISTINCT order_id) AS total_orders,
       {hud('sum(c)', 'count(DISTINCT order_id) * 100', 2)} AS aov
FROM ext_ WHERE order_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND category IN ('budget', 'large_goods')""")

# ---------------------------------------------------------------- EDA (N01-N04d)
_q("daily_order_volume", _VIEWS, "SELECT order_date, CAST(orders AS BIGINT) AS orders FROM vw_daily_orders_")
_q("daily_order_head_tail", _VIEWS, """
(SELECT order_date, CAST(orders AS BIGINT) AS orders, 'head' AS part FROM vw_daily_orders_ WHERE orders > 0 ORDER BY order_date ASC NULLS LAST LIMIT 15)
UNION ALL
(SELECT order_date, CAST(orders AS BIGINT) AS orders, 'tail' AS part FROM vw_daily_orders_ WHERE orders > 0 ORDER BY order_date DESC NULLS FIRST LIMIT 20)""")
_q("gap_days", """
bounds_ AS (SELECT CAST(min(order_purchase_timestamp) AS DATE) AS s, CAST(max(order_purchase_timestamp) AS DATE) AS e
            FROM fact_orders),
spine_ AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS calendar_day FROM bounds_),
days_ AS (SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS d FROM fact_orders)
""", "SELECT calendar_day FROM spine_ LEFT JOIN days_ ON calendar_day = d WHERE d IS NULL")
#: A time is missing where it is not counted.
_q("nulls_by_status", """
present_ AS (
    SELECT order_status, count(*) AS orders, count(order_approved_at) AS approved,
           count(order_delivered_carrier_date) AS carried, count(order_delivered_customer_date) AS delivered
    FROM fact_orders GROUP BY order_status)
""", """
SELECT order_status, orders, orders - approved AS null_approved_at, orders - carried AS null_delivered_carrier,
       orders - delivered AS null_delivered_customer
FROM present_""")
#: Lines are counted per product, products then per name; the 15 first places by count, then name.
_q("category_item_counts", """
sold_ AS (SELECT product_id, count(*) AS n FROM fact_order_items GROUP BY product_id),
named_ AS (
    SELECT ifnull(product_category_name_english, 'unknown') AS category, CAST(sum(n) AS BIGINT) AS items
    FROM sold_ JOIN dim_products USING (product_id) GROUP BY category)
""", "SELECT category, items FROM named_ QUALIFY row_number() OVER (ORDER BY items DESC, category) <= 15")
#: Persons are made distinct per state first; the 10 first places by count, then state.
_q("state_person_counts", """
resident_ AS (SELECT DISTINCT customer_state, customer_unique_id FROM dim_customers WHERE customer_unique_id IS NOT NULL),
people_ AS (SELECT customer_state, count(*) AS customers FROM resident_ GROUP BY customer_state)
""", "SELECT customer_state, customers FROM people_ QUALIFY row_number() OVER (ORDER BY customers DESC, customer_state) <= 10")


def _describe_sql(col: str) -> str:
    return (f"COUNT({col}) AS \"count\", {hud(f'SUM({col})', f'COUNT({col})', 6)} AS mean, "
            f"round(stddev_samp({col}), 6) AS std, CAST(min({col}) AS DOUBLE) AS min, "
            f"quantile_cont({col}, 0.25) AS q25, quantile_cont({col}, 0.5) AS q50, "
            f"quantile_cont({col}, 0.75) AS q75, CAST(max({col}) AS DOUBLE) AS max")


_DD = "(SELECT delivery_days FROM fact_orders WHERE order_status = 'delivered' AND delivery_days IS NOT NULL)"
_q("delivery_days_summary", "", f"SELECT {_describe_sql('delivery_days')} FROM {_DD}")
_q("delivery_days_histogram", f"""
dd_ AS {_DD},
mm_ AS (SELECT min(delivery_days) AS lo, max(delivery_days) AS hi FROM dd_),
b_ AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((delivery_days - lo) * 40 / (hi - lo)), 39) END AS BIGINT) AS bin,
              lo, hi FROM dd_, mm_)
""", """
SELECT bin,
       CAST(lo AS DOUBLE) + (CAST(hi - lo AS DOUBLE) / CAST(40 AS DOUBLE)) * CAST(bin AS DOUBLE) AS bin_start,
       CAST(lo AS DOUBLE) + (CAST(hi - lo AS DOUBLE) / CAST(40 AS DOUBLE)) * CAST(bin + 1 AS DOUBLE) AS bin_end,
       COUNT(*) AS orders
FROM b_ GROUP BY bin, lo, hi""")


# ---------------------------------------------------------------- segments
_q("cohort_pct_matrix", _COHORT, f"""
SELECT {_MONTH('ym')} AS cohort, CAST(n AS BIGINT) AS cohort_size, CAST(gap AS BIGINT) AS month_offset,
       {pct('people', 'n')} AS active_pct
FROM active_ JOIN (SELECT ym, people AS n FROM active_ WHERE gap = 0) USING (ym)""")

_q("rfm_person_base", _RFM, f"""
SELECT person AS customer_unique_id, last_order, frequency, {money('c')} AS monetary FROM rfm_""")

#: The quintile of a place among n: the number of fifths of (n - 1) that it lies above.
_SEG = _RFM + """,
graded_ AS (SELECT *, CASE WHEN n < 2 THEN 1 ELSE greatest(1, (r_at * 5 + n - 2) // (n - 1)) END AS r FROM placed_),
seg_ AS (SELECT *, CASE WHEN r >= 4 THEN CASE f_bucket WHEN 1 THEN 'Recent One-Time (acquisition pool)' ELSE 'Champions (repeat, recent)' END
                        ELSE CASE f_bucket WHEN 1 THEN 'Lapsed One-Time' ELSE 'At-Risk Repeat (repeat, not recent)' END END AS segment
         FROM graded_)
"""
_q("rfm_segments", _SEG, f"""
SELECT person AS customer_unique_id, last_order, frequency, {money('c')} AS monetary, CAST(r AS BIGINT) AS r_score,
       CAST(f_bucket AS BIGINT) AS f_bucket, segment
FROM seg_""")
_q("segment_summary", _SEG, f"""
SELECT segment, count(*) AS customers, {money('sum(c)')} AS revenue, {pct('sum(c)', '(SELECT sum(c) FROM rfm_)')} AS revenue_share_pct,
       {pct('count(*)', '(SELECT count(*) FROM rfm_)')} AS customer_share_pct
FROM seg_ GROUP BY segment""")

# ---------------------------------------------------------------- statistics
_q("late_review_describe", _SCORED, f"SELECT is_late, {_describe_sql('score')} FROM scored_ GROUP BY is_late")
_q("review_effect_size", _SCORED, f"""
SELECT is_late, count(*) AS n, {hud('sum(score)', 'count(score)', 3)} AS mean, round(CAST(median(score) AS DOUBLE), 3) AS median,
       {pct('count_if(score <= 2)', 'count(*)')} AS pct_1_2_star
FROM scored_ GROUP BY is_late""")
_U_CTES = _SCORED + """,
c_ AS (SELECT score AS v, count(*) FILTER (WHERE is_late) AS n1,
              count(*) FILTER (WHERE NOT is_late) AS n2, count(*) AS t
       FROM scored_ WHERE score IS NOT NULL GROUP BY 1),
r_ AS (SELECT *, SUM(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - t AS before FROM c_),
p_ AS (SELECT COALESCE(SUM(n1), 0) AS n1, COALESCE(SUM(n2), 0) AS n2,
              COALESCE(SUM(CAST(n1 AS HUGEINT) * (2 * before + t + 1)), 0) AS r1x2,
              COALESCE(SUM(CAST(t AS HUGEINT) * t * t - t), 0) AS ties
       FROM r_),
s_ AS (SELECT n1, n2, CAST(r1x2 - CAST(n1 AS HUGEINT) * (n1 + 1) AS DOUBLE) / CAST(2 AS DOUBLE) AS u1,
              CAST(n1 AS DOUBLE) AS d1, CAST(n2 AS DOUBLE) AS d2, CAST(ties AS DOUBLE) AS dt
       FROM p_),
v_ AS (SELECT *, d1 * d2 / CAST(12 AS DOUBLE) * (((d1 + d2) + CAST(1 AS DOUBLE)) - dt / ((d1 + d2) * ((d1 + d2) - CAST(1 AS DOUBLE)))) AS var
       FROM s_)
"""
_U_SELECT = """
SELECT CAST(n1 AS BIGINT) AS n_late, CAST(n2 AS BIGINT) AS n_on_time, u1 AS u_statistic,
       round(CASE WHEN d1 > 0 AND d2 > 0 AND var > 0
                  THEN (u1 - d1 * d2 / CAST(2 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / sqrt(var) END, 9) AS z
FROM v_"""
_q("mann_whitney_u", _U_CTES, _U_SELECT)

#: The published Chebyshev fit of erfc, highest power first.
_FIT = [0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223]
_POLY = "CAST(0 AS DOUBLE)"
for _c in _FIT:
    _POLY = f"({_POLY} * t + CAST({_c} AS DOUBLE))"
_q("mann_whitney_pvalue", _U_CTES + f""",
u_ AS ({_U_SELECT}),
x_ AS (SELECT *, -z / sqrt(CAST(2 AS DOUBLE)) AS x FROM u_),
t_ AS (SELECT *, 1 / (1 + abs(x) / CAST(2 AS DOUBLE)) AS t FROM x_),
e_ AS (SELECT *, t * exp({_POLY} - x * x) AS upper FROM t_)
""", """
SELECT n_late, n_on_time, u_statistic, z,
       round(CASE WHEN x < 0 THEN (2 - upper) / 2 ELSE upper / 2 END, 9) AS p_value
FROM e_""")


# ---------------------------------------------------------------- forecasting
_SERIES = """
sb_ AS (SELECT CAST(min(order_purchase_timestamp) AS DATE) AS s, CAST(max(order_purchase_timestamp) AS DATE) AS e
        FROM fact_orders),
sc_ AS (SELECT CAST(order_purchase_timestamp AS DATE) AS day, count(*) AS orders FROM fact_orders GROUP BY 1),
sd_ AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM sb_),
series_ AS (
    SELECT 'all' AS series_id, sd_.day, CAST(date_diff('day', sb_.s, sd_.day) AS BIGINT) AS day_index,
           CAST(COALESCE(sc_.orders, 0) AS BIGINT) AS orders
    FROM sd_ CROSS JOIN sb_ LEFT JOIN sc_ ON sc_.day = sd_.day),
len_ AS (SELECT series_id, count(*) AS len, min(day) AS first_day FROM series_ GROUP BY 1),
folds_ AS (
    SELECT series_id, CAST(f AS BIGINT) AS fold, len - (6 - f + 1) * 28 AS test_start_idx, first_day
    FROM len_ CROSS JOIN range(1, 7) t(f)
    WHERE len - (6 - f + 1) * 28 >= 7),
td_ AS (SELECT series_id, fold, test_start_idx,
               unnest(generate_series(test_start_idx, test_start_idx + 27)) AS day_index FROM folds_),
sn_ AS (
    SELECT td_.series_id, td_.fold, a.day, td_.day_index, a.orders AS actual, CAST(p.orders AS DOUBLE) AS forecast
    FROM td_ JOIN series_ a ON a.series_id = td_.series_id AND a.day_index = td_.day_index
    JOIN series_ p ON p.series_id = td_.series_id
                  AND p.day_index = td_.test_start_idx - 7 + (td_.day_index - td_.test_start_idx) % 7),
end_ AS (SELECT series_id, max(day_index) AS last_idx, max(day) AS last_day FROM series_ GROUP BY 1),
fut_ AS (
    SELECT e.series_id, st.step, e.last_day + CAST(st.step + 1 AS INTEGER) AS date, CAST(p.orders AS DOUBLE) AS f
    FROM end_ e CROSS JOIN range(0, 28) st(step)
    JOIN series_ p ON p.series_id = e.series_id AND p.day_index = e.last_idx - 7 + 1 + st.step % 7),
q_ AS (SELECT series_id, quantile_cont(actual - forecast, 0.025) AS lq,
              quantile_cont(actual - forecast, 0.975) AS uq FROM sn_ GROUP BY 1),
snf_ AS (SELECT series_id, date, f AS forecast, round(greatest(f + lq, 0.0), 6) AS lower, round(f + uq, 6) AS upper
         FROM fut_ JOIN q_ USING (series_id))
"""
_q("daily_series", _SERIES, "SELECT series_id, day, day_index, orders FROM series_")
_q("walk_forward_folds", _SERIES, """
SELECT series_id, fold, test_start_idx, first_day + CAST(test_start_idx AS INTEGER) AS test_start,
       first_day + CAST(test_start_idx + 27 AS INTEGER) AS test_end
FROM folds_""")
_q("event_lift", _SERIES + """,
w_ AS (SELECT series_id, day, orders,
              avg(orders) OVER (PARTITION BY series_id ORDER BY day_index
                                RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING) AS base
       FROM series_),
ff_ AS (SELECT series_id, min(first_day + CAST(test_start_idx AS INTEGER)) AS first_test FROM folds_ GROUP BY 1)
""", """
SELECT w_.series_id, day, orders, round(base, 9) AS baseline_avg,
       round(CAST(orders AS DOUBLE) / NULLIF(base, 0), 9) AS lift,
       CAST(date_diff('day', day, first_test) AS BIGINT) AS days_before_first_fold
FROM w_ LEFT JOIN ff_ USING (series_id)""")
_q("series_by_state", _SERIES + """,
placed_ AS (SELECT c.customer_state AS series_id, CAST(o.order_purchase_timestamp AS DATE) AS day, count(*) AS n
            FROM fact_orders o JOIN dim_customers c USING (customer_id) GROUP BY 1, 2),
state_day_ AS (
    SELECT k.series_id, sd_.day, coalesce(p.n, 0) AS orders
    FROM (SELECT DISTINCT series_id FROM placed_) k CROSS JOIN sd_
    LEFT JOIN placed_ p ON p.series_id IS NOT DISTINCT FROM k.series_id AND p.day = sd_.day),
state_lift_ AS (
    SELECT *, CASE WHEN sum(orders) OVER before > 0
                   THEN orders * count(*) OVER before / CAST(sum(orders) OVER before AS DOUBLE) END AS lift,
           row_number() OVER (PARTITION BY series_id ORDER BY day DESC) AS from_end
    FROM state_day_
    WINDOW before AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)),
top_ AS (SELECT series_id, max(lift) AS lift FROM state_lift_ GROUP BY 1)
""", """
SELECT s.series_id, count(*) AS days, CAST(sum(orders) AS BIGINT) AS orders, count(*) FILTER (WHERE orders = 0) AS gap_days,
       round(max(s.lift), 9) AS max_lift, min(day) FILTER (WHERE s.lift = t.lift) AS max_lift_day,
       CAST(4 * sum(orders) FILTER (WHERE from_end <= 7) AS BIGINT) AS forecast_total
FROM state_lift_ s JOIN top_ t ON t.series_id IS NOT DISTINCT FROM s.series_id GROUP BY s.series_id""")
_q("seasonal_naive_backtest", _SERIES, """
SELECT series_id, fold, min(day) AS test_start, max(day) AS test_end,
       sum(abs(actual - forecast)) / NULLIF(sum(abs(actual)), 0) AS wape,
       avg(forecast - actual) AS bias, 'seasonal_naive' AS model
FROM sn_ GROUP BY series_id, fold""")
_q("forecast_seasonal_naive", _SERIES, "SELECT series_id, date, forecast, lower, upper FROM snf_")
_q("forecast_total_seasonal_naive", _SERIES, """
SELECT series_id, sum(forecast) AS forecast_total, sum(lower) AS sum_of_daily_lower,
       sum(upper) AS sum_of_daily_upper
FROM snf_ GROUP BY series_id""")
for _k, (_ctes, _select) in oracle_forecast.statements(_SERIES).items():
    _q(_k, _ctes, _select)


def _selection(name: str, condition: str) -> str:
    return f"""SELECT '{name}' AS selection, {money('sum(e.c)')} AS total_revenue, count(DISTINCT e.order_id) AS total_orders,
       count(DISTINCT b.person) AS customers, {hud('sum(e.c)', '(count(DISTINCT e.order_id) * 100)')} AS aov
FROM ext_ e JOIN buyer_ b USING (order_id) WHERE {condition}"""


_q("kpi_any_slice", _VIEWS, "\nUNION ALL\n".join([
    _selection("all", "TRUE"),
    _selection("range", "e.month BETWEEN '1993-02' AND '1994-11' AND e.category IN ('budget', 'large_goods', 'unknown')"),
    _selection("states", "e.month >= '1995-01' AND e.state IN ('NATION_1', 'NATION_3', 'NATION_7')")]))


# ---------------------------------------------------------------- published snapshots
_q("published_star", """
ends_ AS (SELECT CAST(min(order_purchase_timestamp) AS DATE) AS s, CAST(max(order_purchase_timestamp) AS DATE) AS e FROM fact_orders)
""", "SELECT 'dim_date' AS \"table\", date_diff('day', s, e) + 1 AS \"rows\" FROM ends_\nUNION ALL\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}', count(*) FROM {t}" for t in ("dim_customers", "dim_products", "dim_sellers", "fact_orders", "fact_order_items",
                                                  "order_payments", "order_reviews", "geolocation")))
_q("catalog_views", _VIEWS + """,
by_sold_ AS (SELECT order_date, sum(c) AS revenue_cents, count(*) AS items FROM vw_sales_ GROUP BY order_date),
by_sent_ AS (SELECT order_date, count(*) AS delivered_orders, count(*) FILTER (WHERE is_late) AS late_orders,
                 sum(review_score) AS score_sum, count(review_score) AS scores FROM vw_orders_ GROUP BY order_date),
by_new_ AS (SELECT CAST(first_order AS DATE) AS order_date, count(*) AS new_customers, count(*) FILTER (WHERE is_repeat) AS to_return,
                sum(c) AS lifetime_cents FROM vw_customers_ GROUP BY CAST(first_order AS DATE))
""", """
SELECT order_date, CAST(orders AS BIGINT) AS orders, delivered_orders, late_orders, CAST(score_sum AS BIGINT) AS score_sum, scores,
       CAST(revenue_cents AS BIGINT) AS revenue_cents, items, new_customers, to_return, CAST(lifetime_cents AS BIGINT) AS lifetime_cents
FROM vw_daily_orders_ LEFT JOIN by_sold_ USING (order_date) LEFT JOIN by_sent_ USING (order_date) LEFT JOIN by_new_ USING (order_date)""")
_q("kpi_revenue_published", _VIEWS, f"""
SELECT {money('sum(c)')} AS total_revenue, count(DISTINCT order_id) AS total_orders,
       {hud('sum(c)', '(count(DISTINCT order_id) * 100)')} AS aov
FROM vw_sales_ WHERE order_date BETWEEN DATE '1994-03-15' AND DATE '1995-02-10'""")


# ---------------------------------------------------------------- sources and run-all
# Order-free column hashes: numbers to four decimals, times to the microsecond, then the sum of
# the first eight hex digits of each value's MD5.
_X = "CAST(COLUMNS(*) AS VARCHAR)"
_HASH = f"""CAST('0x' || substr(md5(CASE WHEN {_X} IS NULL THEN '~'
    WHEN TRY_CAST({_X} AS DOUBLE) BETWEEN -1e14 AND 1e14 THEN CAST(CAST(round(TRY_CAST({_X} AS DOUBLE) * 10000) AS HUGEINT) AS VARCHAR)
    WHEN length({_X}) >= 10 AND TRY_CAST({_X} AS TIMESTAMP) IS NOT NULL THEN strftime(TRY_CAST({_X} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')
    ELSE {_X} END), 1, 8) AS BIGINT)"""


def _hashes(name: str, value: str, select: str) -> str:
    return f"""SELECT '{value}' AS {name}, "column", count(*) AS "rows", CAST(sum(hash) AS BIGINT) AS hash
FROM (UNPIVOT (SELECT {_HASH} FROM ({select})) ON COLUMNS(*) INTO NAME "column" VALUE hash) GROUP BY "column\""""


_q("stage_all", "", "\nUNION ALL\n".join(_hashes('"table"', t, f"SELECT * FROM stg_{t}") for t in _STG))

_RUN_ALL = ["monthly_revenue_mom", "aov_trend", "category_pareto", "revenue_by_state", "payment_mix",
            "seller_concentration", "order_status_funnel", "delivery_days_distribution",
            "late_pct_by_month", "late_pct_by_state", "late_vs_review", "cohort_retention",
            "repeat_purchase_rate", "rfm_scores", "rfm_segment_share", "items_vs_payments",
            "duplicate_review_orders", "temporal_violations"]
for _k in ("run_all_queries", "result_samples"):
    ORACLE[_k] = "\nUNION ALL\n".join(f"SELECT * FROM ({_hashes('query', n, ORACLE[n])})" for n in _RUN_ALL)
_q("pivot_extract", _VIEWS + """,
cell_ AS (SELECT category, month, sum(c) AS c FROM ext_ GROUP BY CUBE (category, month)),
axis_ AS (SELECT DISTINCT category FROM cell_), months_ AS (SELECT DISTINCT month FROM cell_),
pivot_ AS (
    SELECT ifnull(a.category, 'Total') AS category, ifnull(m.month, 'Total') AS month, coalesce(c.c, 0) / 100.0 AS revenue
    FROM axis_ a CROSS JOIN months_ m LEFT JOIN cell_ c ON c.category IS NOT DISTINCT FROM a.category AND c.month IS NOT DISTINCT FROM m.month)
""", "\nUNION ALL\n".join([
    _hashes("output", "raw_extract", "SELECT order_id, category, state, order_date, month, c / 100.0 AS line_revenue, c AS line_cents FROM ext_"),
    _hashes("output", "category_month_pivot", "SELECT category, month, revenue FROM pivot_"),
    _hashes("output", "state_pivot", "SELECT state, count(DISTINCT order_id) AS orders, sum(c) / 100.0 AS revenue FROM ext_ GROUP BY state")]))
