"""Named sub-queries of the comparison SQL (DuckDB dialect), written independently of the Spark plans."""

from __future__ import annotations

import re

SNAPSHOT = "DATE '2001-08-02'"
BASE, COMPARISON = 1999, 2000


def micro(expression: str) -> str:
    """A decimal as a whole number of millionths."""
    return f"CAST(({expression}) * 1000000 AS HUGEINT)"


def quotient(numerator: str, denominator: str, digits: int) -> str:
    """Exact division of two whole numbers, halves rounded away from zero, NULL for a zero divisor.

    Whole numbers only: a quotient of doubles may fall on the wrong side of a half.
    """
    scaled = 2 * 10**digits
    n, d = f"({numerator})", f"({denominator})"
    return (
        f"(CASE WHEN {d} <> 0 THEN sign({n}) * sign({d}) * "
        f"CAST(({scaled} * abs({n}) + abs({d})) // (2 * abs({d})) AS DOUBLE) / {10**digits} END)"
    )


def calendar(padded: bool) -> str:
    month_name = "rpad(monthname(order_date), 9, ' ')" if padded else "monthname(order_date)"
    return f"""
        CAST(year(order_date) AS INTEGER) AS year,
        CAST(quarter(order_date) AS INTEGER) AS quarter,
        CAST(month(order_date) AS INTEGER) AS month,
        {month_name} AS month_name,
        CAST(week(order_date) AS INTEGER) AS week,
        strftime(order_date, '%Y-%m') AS year_month,
        strftime(order_date, '%Y') || '-Q' || CAST(quarter(order_date) AS VARCHAR) AS year_quarter,
        CAST(CASE WHEN month(order_date) >= 7 THEN year(order_date) + 1 ELSE year(order_date) END AS INTEGER) AS fiscal_year,
        CAST((month(order_date) + 5) % 12 // 3 + 1 AS INTEGER) AS fiscal_quarter"""


def title_list(expression: str) -> str:
    """Title case by list functions, for use in plain projections."""
    return (
        f"array_to_string(list_transform(range(1, length({expression}) + 1), lambda i: "
        rf"CASE WHEN i > 1 AND regexp_matches(substr({expression}, i - 1, 1), '\p{{L}}') "
        f"THEN lower(substr({expression}, i, 1)) ELSE upper(substr({expression}, i, 1)) END), '')"
    )


SEGMENT = """CASE WHEN rfm_score >= 13 THEN 'Champions' WHEN rfm_score >= 10 THEN 'Loyal Customers'
             WHEN rfm_score >= 7 THEN 'Potential Loyalists' WHEN rfm_score >= 4 THEN 'Needs Attention'
             ELSE 'At Risk' END"""


def _edges(measure: str) -> str:
    """Inner quintile edges: linear interpolation from the nearer end, on exact ranks."""
    return f"""
    SELECT '{measure}' AS measure, t,
           CASE WHEN share < 0.5 THEN lo + (hi - lo) * share ELSE hi - (hi - lo) * (1 - share) END AS edge
    FROM (
        SELECT t, (((n - 1) * t) % 5) / CAST(5 AS DOUBLE) AS share,
               max(CASE WHEN rn = (n - 1) * t // 5 + 1 THEN v END) AS lo,
               max(CASE WHEN rn = ((n - 1) * t + 4) // 5 + 1 THEN v END) AS hi
        FROM (SELECT CAST({measure} AS DOUBLE) AS v, row_number() OVER (ORDER BY {measure}) AS rn,
                     count(*) OVER () AS n FROM rfm_a_base), range(1, 5) steps(t)
        GROUP BY t, n
    )"""


def _bin(measure: str) -> str:
    return f"""CAST(1 + (SELECT count(*) FROM qcut_edges e
               WHERE e.measure = '{measure}' AND e.edge < CAST(b.{measure} AS DOUBLE)) AS INTEGER)"""


CTES: dict[str, str] = {
    "raw_orders": """
        SELECT l_orderkey * 10 + l_linenumber AS order_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(l_shipdate AS DATE) AS ship_date, o_custkey AS customer_id,
               CASE WHEN l_partkey % 53 = 7 THEN -l_partkey ELSE l_partkey END AS product_id,
               CASE WHEN o_custkey % 41 = 5 THEN 'Atlantis' ELSE n_name END AS country,
               CASE o_orderstatus WHEN 'F' THEN 'Web' WHEN 'O' THEN 'Mobile App' ELSE 'Marketplace' END AS channel,
               CAST(l_quantity AS INTEGER) % 7 AS quantity,
               CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
               CAST(CAST(l_discount AS DECIMAL(4,2)) * 6 AS DECIMAL(4,2)) AS discount,
               CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS DECIMAL(12,2)) AS shipping_cost,
               CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'Credit Card' WHEN '2' THEN 'PayPal'
                    WHEN '3' THEN 'Bank Transfer' WHEN '4' THEN 'Apple Pay' ELSE 'Klarna' END AS payment_method
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "raw_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               'S' || CAST(p_size AS VARCHAR) AS sub_category, p_brand AS brand,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(40 + p_size % 20 AS DECIMAL(4,0))
                    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,4)) AS unit_cost,
               CAST(p_retailprice AS DECIMAL(12,2)) AS list_price, DATE '1990-01-01' AS launch_date
        FROM part""",
    "raw_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment, n_name AS country,
               'City ' || CAST(c_nationkey AS VARCHAR) AS city, DATE '1990-01-01' AS acquisition_date,
               CASE c_custkey % 6 WHEN 0 THEN 'Paid Search' WHEN 1 THEN 'Organic Search' WHEN 2 THEN 'Direct'
                    WHEN 3 THEN 'Email' WHEN 4 THEN 'Social' ELSE 'Referral' END AS acquisition_channel
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_returns": """
        SELECT l_orderkey * 10 + l_linenumber AS order_id, CAST(l_shipdate AS DATE) AS return_date,
               CASE l_linestatus WHEN 'F' THEN 'Wrong size' ELSE 'Damaged' END AS reason
        FROM lineitem WHERE l_returnflag = 'R'""",
    "raw_sales_targets": """
        SELECT n_name AS country, year_month,
               CAST(10000 + 1000 * n_nationkey + 500 * CAST(split_part(year_month, '-', 2) AS INTEGER)
                    AS DECIMAL(12,2)) AS target_revenue
        FROM nation, (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS year_month FROM orders)""",
    "faulty_orders": """
        SELECT order_id, order_date, ship_date, CASE WHEN order_id % 131 = 9 THEN -customer_id ELSE customer_id END AS customer_id,
               product_id, CASE WHEN order_id % 107 = 5 THEN 'Land ' || CAST(order_id % 8 AS VARCHAR) ELSE country END AS country,
               CASE WHEN order_id % 101 = 1 THEN 'Fax' WHEN order_id % 103 = 2 THEN NULL ELSE channel END AS channel, quantity,
               CAST(CASE WHEN order_id % 109 = 4 THEN 0 WHEN order_id % 113 = 6 THEN unit_price * 40 ELSE unit_price END
                    AS DECIMAL(12,2)) AS unit_price, discount,
               CAST(CASE WHEN order_id % 127 = 8 THEN -1 WHEN order_id % 137 = 10 THEN 900 ELSE shipping_cost END
                    AS DECIMAL(12,2)) AS shipping_cost, payment_method
        FROM (SELECT *, unnest(range(CASE WHEN order_id % 211 = 3 THEN 3 ELSE 1 END)) FROM raw_orders)""",
    "faulty_products": """
        SELECT * REPLACE (CASE WHEN product_id % 29 = 3 THEN 'Other' ELSE category END AS category,
               CAST(CASE WHEN product_id % 31 = 4 THEN list_price * 0.95 WHEN product_id % 37 = 5 THEN list_price * 1.2
                    ELSE unit_cost END AS DECIMAL(14,4)) AS unit_cost,
               CAST(CASE WHEN product_id % 41 = 6 THEN 0 ELSE list_price END AS DECIMAL(12,2)) AS list_price,
               CASE WHEN product_id % 43 = 7 THEN NULL ELSE brand END AS brand)
        FROM (SELECT * EXCLUDE (n) FROM (
            SELECT *, unnest(range(CASE WHEN product_id % 47 = 8 THEN 3 ELSE 1 END)) AS n FROM raw_products))""",
    "faulty_customers": """
        SELECT * REPLACE (CASE WHEN customer_id % 53 = 3 THEN 'Private' ELSE segment END AS segment,
               CASE WHEN customer_id % 59 = 4 THEN 'Nowhere' ELSE country END AS country,
               CASE WHEN customer_id % 61 = 5 THEN NULL ELSE city END AS city)
        FROM (SELECT * EXCLUDE (n) FROM (
            SELECT *, unnest(range(CASE WHEN customer_id % 67 = 6 THEN 3 ELSE 1 END)) AS n FROM raw_customers))""",
    "faulty_returns": """
        SELECT * REPLACE (CASE WHEN order_id % 71 = 5 THEN -order_id WHEN order_id % 73 = 6 THEN NULL ELSE order_id END AS order_id)
        FROM (SELECT * EXCLUDE (n) FROM (
            SELECT *, unnest(range(CASE WHEN order_id % 79 = 7 THEN 3 ELSE 1 END)) AS n FROM raw_returns))""",
    "stg_orders": """
        SELECT order_id, customer_id, product_id, order_date, ship_date, country, channel, payment_method, quantity,
               unit_price, discount, shipping_cost, CAST(ship_date - order_date AS INTEGER) AS shipping_days,
               CAST(unit_price * quantity AS DECIMAL(18,6)) AS gross_revenue,
               CAST(unit_price * quantity * (1 - discount) AS DECIMAL(18,6)) AS net_revenue
        FROM raw_orders
        WHERE discount BETWEEN 0 AND 0.5 AND unit_price > 0 AND quantity BETWEEN 1 AND 5 AND ship_date >= order_date""",
    "stg_products": f"""
        SELECT *, {quotient("CAST((list_price - unit_cost) * 10000 AS HUGEINT)", "CAST(list_price * 10000 AS HUGEINT)", 4)}
                  AS product_margin_pct
        FROM raw_products""",
    "stg_sales_targets": """
        SELECT country, year_month, CAST(split_part(year_month, '-', 1) AS INTEGER) AS year,
               CAST(split_part(year_month, '-', 2) AS INTEGER) AS month, target_revenue
        FROM raw_sales_targets""",
    "int_orders_enriched": f"""
        SELECT *, CASE WHEN net_revenue > 0
                       THEN {quotient(micro("gross_profit"), micro("net_revenue"), 4)} ELSE 0 END AS margin_pct,
               {calendar(padded=True)},
               CASE WHEN discount = 0 THEN 'No discount' WHEN discount <= 0.10 THEN '1-10%'
                    WHEN discount <= 0.20 THEN '11-20%' WHEN discount <= 0.30 THEN '21-30%'
                    ELSE '31-50%' END AS disc_tier
        FROM (
            SELECT o.*, p.product_name, p.category, p.sub_category, p.brand, p.unit_cost, p.list_price,
                   p.product_margin_pct,
                   CAST(o.unit_price * o.quantity * o.discount AS DECIMAL(18,6)) AS discount_amount,
                   CAST(p.unit_cost * o.quantity AS DECIMAL(18,6)) AS cogs,
                   CAST(o.net_revenue - CAST(p.unit_cost * o.quantity AS DECIMAL(18,6)) AS DECIMAL(18,6)) AS gross_profit
            FROM stg_orders o LEFT JOIN stg_products p USING (product_id)
        )""",
    "first_returns": """
        SELECT order_id, return_date, reason FROM raw_returns
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY return_date, reason) = 1""",
    "fct_orders": """
        SELECT o.*, CAST(CASE WHEN r.order_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_return,
               r.reason AS return_reason
        FROM int_orders_enriched o LEFT JOIN raw_returns r USING (order_id)""",
    "fct_orders_first_return": """
        SELECT o.*, CAST(CASE WHEN r.order_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_return,
               r.reason AS return_reason
        FROM int_orders_enriched o LEFT JOIN first_returns r USING (order_id)""",
    "rfm_b_base": f"""
        SELECT customer_id, CAST({SNAPSHOT} - max(order_date) AS INTEGER) AS recency,
               count(DISTINCT order_id) AS frequency, sum(net_revenue) AS exact_monetary,
               round(sum(net_revenue), 2) AS monetary,
               min(order_date) AS first_order_date, max(order_date) AS last_order_date
        FROM stg_orders GROUP BY customer_id""",
    "int_customer_rfm": f"""
        SELECT *, {SEGMENT} AS segment, monetary AS revenue, frequency AS orders,
               round(monetary * 1.5, 2) AS clv_estimate
        FROM (
            SELECT *, r + f + m AS rfm_score
            FROM (
                SELECT * EXCLUDE (exact_monetary),
                       CAST(6 - ntile(5) OVER (ORDER BY recency, customer_id) AS INTEGER) AS r,
                       CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f,
                       CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m
                FROM rfm_b_base
            )
        )""",
    "clean_orders": f"""
        SELECT order_id, order_date, ship_date, customer_id, product_id, {title_list("country")} AS country, channel,
               quantity, unit_price, CAST(least(discount, 0.5) AS DECIMAL(6,4)) AS discount, shipping_cost,
               payment_method, CAST(ship_date - order_date AS INTEGER) AS shipping_days
        FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_date, ship_date, customer_id, product_id,
                country, channel, quantity, unit_price, discount, shipping_cost, payment_method) = 1""",
    "clean_products": f"""
        SELECT * REPLACE ({title_list("category")} AS category),
               CAST(list_price - unit_cost AS DOUBLE) / CAST(list_price AS DOUBLE) AS product_margin_pct
        FROM raw_products""",
    "clean_targets": f"""
        SELECT {title_list("country")} AS country, year_month, target_revenue, year, month FROM stg_sales_targets""",
    "orders_enriched": """
        SELECT *, CASE WHEN net_revenue > 0 THEN CAST(gross_profit AS DOUBLE) / CAST(net_revenue AS DOUBLE)
                       ELSE 0 END AS margin_pct
        FROM (
            SELECT o.*, p.unit_cost, p.list_price, p.category, p.sub_category, p.brand, p.product_margin_pct,
                   CAST(o.unit_price * o.quantity AS DECIMAL(18,6)) AS gross_revenue,
                   CAST(o.unit_price * o.quantity * o.discount AS DECIMAL(18,6)) AS discount_amount,
                   CAST(o.unit_price * o.quantity * (1 - o.discount) AS DECIMAL(18,6)) AS net_revenue,
                   CAST(p.unit_cost * o.quantity AS DECIMAL(18,6)) AS cogs,
                   CAST(o.unit_price * o.quantity * (1 - o.discount) - p.unit_cost * o.quantity
                        AS DECIMAL(18,6)) AS gross_profit
            FROM clean_orders o LEFT JOIN clean_products p USING (product_id)
        )""",
    "rfm_a_base": f"""
        SELECT customer_id, CAST({SNAPSHOT} - max(order_date) AS INTEGER) AS recency,
               count(DISTINCT order_id) AS frequency, sum(net_revenue) AS monetary
        FROM orders_enriched GROUP BY customer_id""",
    "qcut_edges": " UNION ALL ".join(_edges(m) for m in ("recency", "frequency", "monetary")),
    "rfm_a_bins": f"""
        SELECT b.*, {_bin("recency")} AS recency_bin, {_bin("frequency")} AS frequency_bin,
               {_bin("monetary")} AS monetary_bin
        FROM rfm_a_base b""",
    "customer_analytics": f"""
        SELECT *, {SEGMENT} AS segment, monetary AS revenue, frequency AS orders, monetary * 1.5 AS clv_estimate
        FROM (
            SELECT customer_id, recency, frequency, monetary, 6 - recency_bin AS r, frequency_bin AS f,
                   monetary_bin AS m, 6 - recency_bin + frequency_bin + monetary_bin AS rfm_score
            FROM rfm_a_bins
        )""",
    "active_base": f"SELECT DISTINCT customer_id FROM orders_enriched WHERE year(order_date) = {BASE}",
    "active_comparison": f"SELECT DISTINCT customer_id FROM orders_enriched WHERE year(order_date) = {COMPARISON}",
    "retained": "SELECT * FROM active_base INTERSECT SELECT * FROM active_comparison",
    "newcomers": "SELECT * FROM active_comparison EXCEPT SELECT * FROM active_base",
    "retention_figures": """
        SELECT *, retained / CAST(base AS DOUBLE) AS retention_rate, 1 - retained / CAST(base AS DOUBLE) AS churn_rate,
               CAST(comparison - base AS DOUBLE) / CAST(base AS DOUBLE) * 100 AS growth_pct
        FROM (
            SELECT (SELECT count(*) FROM active_base) AS base, (SELECT count(*) FROM active_comparison) AS comparison,
                   (SELECT count(*) FROM retained) AS retained, (SELECT count(*) FROM newcomers) AS newcomers,
                   (SELECT CAST(count(*) FILTER (n >= 2) AS DOUBLE) / CAST(count(*) AS DOUBLE) FROM (
                        SELECT count(DISTINCT order_id) AS n FROM orders_enriched GROUP BY customer_id)) AS repeat_rate
        )""",
    "monthly_actual": """
        SELECT country, strftime(order_date, '%Y-%m') AS year_month, sum(net_revenue) AS actual
        FROM orders_enriched GROUP BY ALL""",
    "country_kpis": f"""
        SELECT y.country, rev_{BASE}, rev_{COMPARISON},
               CASE WHEN rev_{BASE} <> 0 THEN CAST(rev_{COMPARISON} - rev_{BASE} AS DOUBLE)
                    / CAST(rev_{BASE} AS DOUBLE) * 100 END AS yoy_growth_pct,
               target_achievement_pct,
               CASE WHEN active <> 0 THEN CAST(rev_{COMPARISON} AS DOUBLE) / active END AS rev_per_customer
        FROM (
            SELECT country, coalesce(sum(net_revenue) FILTER (year(order_date) = {BASE}), 0) AS rev_{BASE},
                   coalesce(sum(net_revenue) FILTER (year(order_date) = {COMPARISON}), 0) AS rev_{COMPARISON},
                   count(DISTINCT customer_id) FILTER (year(order_date) = {COMPARISON}) AS active
            FROM orders_enriched GROUP BY country
        ) y JOIN (
            SELECT country, CAST(sum(actual) AS DOUBLE) / CAST(sum(target_revenue) AS DOUBLE) * 100
                            AS target_achievement_pct
            FROM monthly_actual JOIN clean_targets USING (country, year_month) GROUP BY country
        ) t USING (country)""",
    "country_targets": f"""
        SELECT j.*, y.rev_{BASE}, y.rev_{COMPARISON},
               {quotient(micro(f"100 * (rev_{COMPARISON} - rev_{BASE})"), micro(f"rev_{BASE}"), 2)} AS yoy_growth_pct
        FROM actual_target j LEFT JOIN (
            SELECT country, max(CASE WHEN year = {BASE} THEN actual_revenue END) AS rev_{BASE},
                   max(CASE WHEN year = {COMPARISON} THEN actual_revenue END) AS rev_{COMPARISON}
            FROM actual_target GROUP BY country
        ) y USING (country)""",
    "actual_target": """
        SELECT a.*, t.target_revenue, round(a.actual_revenue - t.target_revenue, 2) AS target_achievement_pct
        FROM (
            SELECT country, year_month, year, sum(net_revenue) AS actual_revenue,
                   count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers
            FROM fct_orders GROUP BY ALL
        ) a LEFT JOIN stg_sales_targets t ON a.country = t.country AND a.year_month = t.year_month""",
}


def statement(final: str) -> str:
    """The final SELECT preceded by the sub-queries it needs, each after those it reads."""
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b{name}\b", sql) and CTES[name] != sql:
                need(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    need(final)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + final
