"""Comparison SQL (DuckDB dialect) for every query that SQL can express."""

from __future__ import annotations

import re

from oracle.ctes import BASE, COMPARISON, SNAPSHOT, micro, quotient, statement, title_list

_FINAL: dict[str, str] = {}


def _doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


ENRICHED_MONEY = (
    "unit_cost", "list_price", "unit_price", "discount", "shipping_cost",
    "gross_revenue", "discount_amount", "net_revenue", "cogs", "gross_profit",
)

# --- lineage B ---------------------------------------------------------------------------------------------
_FINAL["stg_orders"] = f"""
SELECT * REPLACE ({_doubles("unit_price", "discount", "shipping_cost", "gross_revenue", "net_revenue")}) FROM stg_orders"""
_FINAL["stg_products"] = f"""
SELECT * REPLACE ({_doubles("unit_cost", "list_price")}) FROM stg_products"""
_FINAL["stg_customers"] = "SELECT * FROM raw_customers"
_FINAL["stg_returns"] = "SELECT order_id, return_date, reason AS return_reason FROM raw_returns"
_FINAL["stg_sales_targets"] = f"SELECT * REPLACE ({_doubles('target_revenue')}) FROM stg_sales_targets"
_FINAL["int_orders_enriched"] = f"SELECT * REPLACE ({_doubles(*ENRICHED_MONEY)}) FROM int_orders_enriched"
_FINAL["fct_orders"] = f"SELECT * REPLACE ({_doubles(*ENRICHED_MONEY)}) FROM fct_orders"
_FINAL["total_orders_by_month"] = """
SELECT year_month, count(*) AS total_orders FROM fct_orders GROUP BY year_month ORDER BY year_month"""
_FINAL["disc_tier_sql"] = """
SELECT CAST(discount AS DOUBLE) AS discount, disc_tier, count(*) AS orders FROM int_orders_enriched GROUP BY ALL"""
_FINAL["mart_commercial_kpis"] = f"""
SELECT year, quarter, month, year_month, year_quarter, fiscal_year, fiscal_quarter,
       country, channel, category, sub_category, brand, disc_tier,
       count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units,
       count(DISTINCT customer_id) AS unique_customers,
       CAST(round(sum(gross_revenue), 2) AS DOUBLE) AS gross_revenue,
       CAST(round(sum(discount_amount), 2) AS DOUBLE) AS total_discount,
       CAST(round(sum(net_revenue), 2) AS DOUBLE) AS net_revenue,
       {quotient(micro("sum(net_revenue)"), "count(*) * 1000000", 2)} AS avg_order_value,
       CAST(round(sum(cogs), 2) AS DOUBLE) AS total_cogs,
       CAST(round(sum(gross_profit), 2) AS DOUBLE) AS gross_profit,
       {quotient(micro("sum(gross_profit)"), micro("sum(net_revenue)"), 4)} AS blended_margin_pct,
       {quotient(micro("sum(discount)"), "count(*) * 1000000", 4)} AS avg_discount_pct,
       {quotient(micro("sum(discount_amount)"), micro("sum(gross_revenue)"), 4)} AS discount_share_of_gross,
       CAST(sum(is_return) AS BIGINT) AS total_returns,
       {quotient("sum(is_return)", "count(*)", 4)} AS return_rate
FROM fct_orders
GROUP BY year, quarter, month, year_month, year_quarter, fiscal_year, fiscal_quarter,
         country, channel, category, sub_category, brand, disc_tier"""
_FINAL["mart_country_targets"] = f"""
SELECT * REPLACE ({_doubles("actual_revenue", "target_revenue", "target_achievement_pct", f"rev_{BASE}", f"rev_{COMPARISON}")})
FROM country_targets"""
_FINAL["int_customer_rfm"] = f"""
SELECT * REPLACE ({_doubles("monetary", "revenue", "clv_estimate")}) FROM int_customer_rfm"""
_FINAL["mart_customer_kpis"] = f"""
SELECT c.customer_id, c.customer_name, c.segment AS customer_segment, c.country, c.city, c.acquisition_date,
       c.acquisition_channel, r.recency, r.frequency, CAST(r.monetary AS DOUBLE) AS monetary, r.r, r.f, r.m,
       r.rfm_score, r.segment AS rfm_segment, CAST(r.revenue AS DOUBLE) AS total_revenue, r.orders AS total_orders,
       CAST(r.clv_estimate AS DOUBLE) AS clv_estimate, r.first_order_date, r.last_order_date,
       CAST({SNAPSHOT} - c.acquisition_date AS INTEGER) AS tenure_days
FROM raw_customers c LEFT JOIN int_customer_rfm r USING (customer_id)"""
_FINAL["ntile_distributed"] = """
SELECT customer_id, recency, frequency, CAST(exact_monetary AS DOUBLE) AS monetary,
       CAST(ntile(5) OVER (ORDER BY recency, customer_id) AS INTEGER) AS recency_tile,
       CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS frequency_tile,
       CAST(ntile(5) OVER (ORDER BY exact_monetary, customer_id) AS INTEGER) AS monetary_tile
FROM rfm_b_base"""

# --- quality -----------------------------------------------------------------------------------------------
# The column types of the raw tables.
RAW_TYPES = {
    "orders": {
        "order_id": "bigint", "order_date": "date", "ship_date": "date", "customer_id": "bigint",
        "product_id": "bigint", "country": "string", "channel": "string", "quantity": "int",
        "unit_price": "decimal(12,2)", "discount": "decimal(4,2)", "shipping_cost": "decimal(12,2)",
        "payment_method": "string",
    },
    "products": {
        "product_id": "bigint", "product_name": "string", "category": "string", "sub-category": "string",
        "brand": "string", "unit_cost": "decimal(14,4)", "list_price": "decimal(12,2)", "launch_date": "date",
    },
    "customers": {
        "customer_id": "bigint", "customer_name": "string", "segment": "string", "country": "string",
        "city": "string", "acquisition_date": "date", "acquisition_channel": "string",
    },
    "returns": {"order_id": "bigint", "return_date": "date", "reason": "string"},
}


def _null_row(table: str, position: int, column: str, kind: str) -> str:
    c = column.replace("-", "_")
    return f"""
SELECT {position} AS position, '{column}' AS column_name, '{kind}' AS data_type, count({c}) AS filled,
       count(*) - count({c}) AS nulls,
       round_even(CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 2) AS null_pct
FROM {table}"""


_FINAL["profile_nulls"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, * FROM ({_null_row(f'raw_{table}', i, column, kind)})"
    for table, columns in RAW_TYPES.items()
    for i, (column, kind) in enumerate(columns.items(), 1)
)
_FINAL["columns_with_nulls"] = (
    "SELECT * FROM ("
    + " UNION ALL ".join(
        _null_row("int_orders_enriched", position, column, kind)
        for position, column, kind in (
            (10, "product_name", "string"),
            (11, "category", "string"),
            (12, "sub_category", "string"),
            (13, "brand", "string"),
            (14, "unit_cost", "decimal(14,4)"),
            (15, "list_price", "decimal(12,2)"),
            (16, "product_margin_pct", "decimal(18,4)"),
            (24, "cogs", "decimal(18,6)"),
            (25, "gross_profit", "decimal(18,6)"),
            (26, "margin_pct", "decimal(23,4)"),
        )
    )
    + ") WHERE nulls > 0"
)
_FINAL["duplicate_rows"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM raw_{t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{t}))
        AS duplicates"""
    for t in RAW_TYPES
)
NUMERIC = ("unit_price", "discount", "quantity", "shipping_cost")


def _outliers(c: str) -> str:
    return f"""(SELECT count(*) FROM raw_orders, (
        SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM raw_orders)
        WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))"""


_FINAL["iqr_outliers"] = " UNION ALL ".join(
    f"SELECT '{c}' AS measure, {_outliers(c)} AS iqr_outliers" for c in NUMERIC
)
_FINAL["describe_orders"] = " UNION ALL ".join(
    f"""
SELECT '{c}' AS measure, count(v) AS count, round_even(avg(v), 3) AS mean, round_even(stddev_samp(v), 3) AS std,
       round_even(min(v), 3) AS min, round_even(quantile_cont(v, 0.25), 3) AS p25,
       round_even(quantile_cont(v, 0.5), 3) AS p50, round_even(quantile_cont(v, 0.75), 3) AS p75,
       round_even(max(v), 3) AS max, {_outliers(c)} AS iqr_outliers
FROM (SELECT CAST({c} AS DOUBLE) AS v FROM raw_orders)"""
    for c in NUMERIC
)

COUNTRY_LIST = ", ".join(f"'NATION_{i}'" for i in range(25))
CATEGORY_LIST = "'ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'"
SEGMENT_LIST = "'AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'"
CHANNEL_LIST = "'Web', 'Mobile App', 'Marketplace'"
PAYMENT_LIST = "'Credit Card', 'PayPal', 'Bank Transfer', 'Apple Pay', 'Klarna'"
ACQUISITION_LIST = "'Paid Search', 'Organic Search', 'Direct', 'Email', 'Social', 'Referral'"


def _violations(table: str, check: str, source: str, holds: str, detail: str = "''") -> str:
    return f"""SELECT '{table}' AS table_name, '{check}' AS check_name,
       count(*) FILTER (NOT coalesce({holds}, false)) AS violations, {detail} AS detail FROM {source}"""


def _named(column: str, values: str) -> str:
    """The five smallest offending values, and how many more there are."""
    bad = f"FILTER ({column} NOT IN ({values}))"
    return f"""'invalid values: ' || coalesce(array_to_string(list_slice(list_sort(list(DISTINCT {column}) {bad}), 1, 5), ', '), '')
       || CASE WHEN count(DISTINCT {column}) {bad} > 5
          THEN ' and ' || (count(DISTINCT {column}) {bad} - 5) || ' more' ELSE '' END"""


def _repeats(table: str, check: str, source: str, key: str) -> str:
    """Rows beyond the first of each key, NULL being a key."""
    return f"""SELECT '{table}', '{check}', (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {source})), ''"""


def _orphans(table: str, check: str, child: str, parent: str, key: str) -> str:
    return f"""SELECT '{table}', '{check}', count(*), '' FROM {child} c
       WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"""


def _filled(table: str) -> str:
    return " AND ".join(f"{c.replace('-', '_')} IS NOT NULL" for c in RAW_TYPES[table])


_REPORT = " UNION ALL ".join(
    [
        _violations("Orders", "No null values", "raw_orders", _filled("orders")),
        _repeats("Orders", "No duplicate Order IDs", "raw_orders", "order_id"),
        _violations("Orders", "Discount in [0, 0.5]", "raw_orders", "discount BETWEEN 0 AND 0.5"),
        _violations(
            "Orders", "Valid countries", "raw_orders", f"country IN ({COUNTRY_LIST})",
            _named("country", COUNTRY_LIST),
        ),
        _violations("Orders", "Valid channels", "raw_orders", f"channel IN ({CHANNEL_LIST})"),
        _violations("Orders", "Ship Date >= Order Date", "raw_orders", "ship_date >= order_date"),
        _violations("Orders", "Unit Price > 0", "raw_orders", "unit_price > 0"),
        _violations("Orders", "Quantity in [1,5]", "raw_orders", "quantity BETWEEN 1 AND 5"),
        _violations("Orders", "Shipping Cost >= 0", "raw_orders", "shipping_cost >= 0"),
        _violations("Products", "No null values", "raw_products", _filled("products")),
        _repeats("Products", "No duplicate IDs", "raw_products", "product_id"),
        _violations("Products", "Valid categories", "raw_products", f"category IN ({CATEGORY_LIST})"),
        _violations("Products", "Unit Cost < List Price", "raw_products", "unit_cost < list_price"),
        _violations(
            "Products", "Margin > 10%", "raw_products", "list_price <> 0 AND (list_price - unit_cost) * 10 > list_price",
            # A zero list price has no margin.
            "'low-margin: ' || count(*) FILTER (list_price <> 0 AND (list_price - unit_cost) * 10 <= list_price)",
        ),
        _violations("Customers", "No null values", "raw_customers", _filled("customers")),
        _repeats("Customers", "No duplicate IDs", "raw_customers", "customer_id"),
        _violations("Customers", "Valid segments", "raw_customers", f"segment IN ({SEGMENT_LIST})"),
        _violations("Customers", "Valid countries", "raw_customers", f"country IN ({COUNTRY_LIST})"),
        _repeats("Returns", "No duplicate records", "raw_returns", "order_id"),
        _orphans("Returns", "Order IDs exist", "raw_returns", "raw_orders", "order_id"),
        _orphans("Referential", "Order → Customer FK", "raw_orders", "raw_customers", "customer_id"),
        _orphans("Referential", "Order → Product FK", "raw_orders", "raw_products", "product_id"),
    ]
)
_FINAL["quality_report"] = f"SELECT *, violations = 0 AS passed FROM ({_REPORT})"
_FINAL["quality_report_summary"] = f"""
SELECT count(*) FILTER (violations = 0) AS passed, count(*) AS checks FROM ({_REPORT})"""
_FINAL["unique_violations"] = """
SELECT order_id, count(*) AS copies FROM raw_orders GROUP BY order_id HAVING count(*) > 1"""
_FINAL["fk_violations"] = """
SELECT product_id AS key, count(*) AS rows FROM raw_orders o
WHERE NOT EXISTS (SELECT 1 FROM raw_products p WHERE p.product_id = o.product_id) GROUP BY product_id"""


def _unaccepted(table: str, column: str, values: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, {column} AS value, count(*) AS rows
       FROM raw_{table} WHERE {column} NOT IN ({values}) GROUP BY {column}"""


_FINAL["accepted_values"] = " UNION ALL ".join(
    [
        _unaccepted(
            "orders", "country",
            "'France', 'Germany', 'Italy', 'Spain', 'Portugal', 'Netherlands', 'Belgium', 'Ireland'",
        ),
        _unaccepted("orders", "channel", CHANNEL_LIST),
        _unaccepted("orders", "payment_method", PAYMENT_LIST),
        _unaccepted("products", "category", "'Apparel', 'Footwear', 'Accessories', 'Home & Living', 'Beauty'"),
        _unaccepted("customers", "segment", "'Consumer', 'Business', 'Premium'"),
        _unaccepted("customers", "acquisition_channel", ACQUISITION_LIST),
    ]
)


def _test(table: str, column: str, test: str, failures: str, source: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test_name,
       CAST({failures} AS BIGINT) AS failures FROM {source}"""


def _not_null(table: str, column: str, source: str | None = None) -> str:
    c = column.replace("-", "_")
    return _test(table, column, "not_null", f"count(*) - count({c})", source or f"raw_{table}")


def _unique(table: str, column: str, source: str | None = None) -> str:
    repeated = f"""(SELECT 1 FROM {source or f'raw_{table}'} WHERE {column} IS NOT NULL
       GROUP BY {column} HAVING count(*) > 1)"""
    return _test(table, column, "unique", "count(*)", repeated)


def _accepted(table: str, column: str, values: str, source: str | None = None) -> str:
    bad = f"count(DISTINCT {column}) FILTER ({column} NOT IN ({values}))"
    return _test(table, column, "accepted_values", bad, source or f"raw_{table}")


def _related(child: str, parent: str, key: str) -> str:
    orphans = f"""raw_{child} c WHERE {key} IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM raw_{parent} p WHERE p.{key} = c.{key})"""
    return _test(child, key, "relationships", "count(*)", orphans)


MANDATORY = {
    "orders": (
        "order_id", "order_date", "ship_date", "customer_id", "product_id", "country", "quantity", "unit_price",
        "discount", "shipping_cost",
    ),
    "products": ("product_id", "product_name", "sub-category", "brand", "unit_cost", "list_price"),
    "customers": ("customer_id", "country", "acquisition_date"),
    "returns": ("order_id", "return_date", "reason"),
    "sales_targets": ("country", "year-month", "target_revenue"),
}
_FINAL["source_tests"] = "SELECT *, failures = 0 AS passed FROM ({})".format(
    " UNION ALL ".join(
        [
            *[_not_null(t, c) for t, columns in MANDATORY.items() for c in columns],
            _unique("orders", "order_id"),
            _unique("products", "product_id"),
            _unique("customers", "customer_id"),
            _unique("returns", "order_id"),
            _accepted("orders", "country", COUNTRY_LIST),
            _accepted("orders", "channel", CHANNEL_LIST),
            _accepted("orders", "payment_method", PAYMENT_LIST),
            _accepted("products", "category", CATEGORY_LIST),
            _accepted("customers", "segment", SEGMENT_LIST),
            _accepted("customers", "acquisition_channel", ACQUISITION_LIST),
            _related("orders", "customers", "customer_id"),
            _related("orders", "products", "product_id"),
            _related("returns", "orders", "order_id"),
        ]
    )
)
_MART = "(SELECT c.customer_id, r.segment AS rfm_segment FROM raw_customers c LEFT JOIN int_customer_rfm r USING (customer_id))"
_FINAL["mart_tests"] = "SELECT *, failures = 0 AS passed FROM ({})".format(
    " UNION ALL ".join(
        [
            _unique("fct_orders", "order_id", "fct_orders"),
            _not_null("fct_orders", "order_id", "fct_orders"),
            _not_null("fct_orders", "customer_id", "fct_orders"),
            _not_null("fct_orders", "net_revenue", "fct_orders"),
            _accepted("fct_orders", "is_return", "0, 1", "fct_orders"),
            _accepted(
                "fct_orders", "disc_tier", "'No discount', '1-10%', '11-20%', '21-30%', '31-50%'", "fct_orders"
            ),
            _unique("mart_customer_kpis", "customer_id", _MART),
            _not_null("mart_customer_kpis", "customer_id", _MART),
            _accepted(
                "mart_customer_kpis",
                "rfm_segment",
                "'Champions', 'Loyal Customers', 'Potential Loyalists', 'Needs Attention', 'At Risk'",
                _MART,
            ),
        ]
    )
)
# Names and columns of the raw tables and staging models.
_SOURCES = {t: ", ".join(columns) for t, columns in RAW_TYPES.items()} | {"sales_targets": "country, year-month, target_revenue"}
_FINAL["source_tables"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, 0 AS unnamed, '{columns}' AS columns FROM raw_{t}" for t, columns in _SOURCES.items()
)
_FINAL["staging_views"] = " UNION ALL ".join(
    f"""SELECT '{model}' AS model, 'VIEW' AS kind, false AS temporary, count(*) AS row_count, {n} AS column_count,
       {total} AS total FROM {source}"""
    for model, n, total, source in (
        ("stg_orders", 15, "CAST(round(sum(net_revenue), 2) AS DOUBLE)", "stg_orders"),
        ("stg_products", 9, "round(sum(CAST(product_margin_pct AS DOUBLE)), 2)", "stg_products"),
        ("stg_customers", 7, "CAST(NULL AS DOUBLE)", "raw_customers"),
        ("stg_returns", 3, "CAST(NULL AS DOUBLE)", "raw_returns"),
        ("stg_sales_targets", 5, "CAST(round(sum(target_revenue), 2) AS DOUBLE)", "stg_sales_targets"),
    )
)
_FINAL["csv_corrupt_dates"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS records, count(*) FILTER ({bad}) AS corrupt FROM raw_{t}"
    for t, bad in (
        ("orders", "order_id % 97 = 3 OR order_id % 89 = 4"), ("products", "false"), ("customers", "false"),
        ("returns", "order_id % 83 = 5"), ("sales_targets", "false"),
    )
)
_FINAL["cleaning_row_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_read, count({kept}) AS rows_written, count(*) - count({kept}) AS removed FROM raw_{t}"
    for t, kept in (
        ("orders", "DISTINCT order_id"), ("products", "*"), ("customers", "*"), ("returns", "DISTINCT order_id"), ("sales_targets", "*"),
    )
)
for _name in ("quality_report", "source_tests", "profile_nulls", "duplicate_rows", "describe_orders", "iqr_outliers"):
    # The same over tables with planted faults; sales targets have none.
    _FINAL[f"{_name}_faulty"] = re.sub(r"\braw_(orders|products|customers|returns)\b", r"faulty_\1", _FINAL[_name])
_FINAL["table_shapes"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, {n} AS column_count FROM raw_{t}"
    for t, n in (("orders", 12), ("products", 8), ("customers", 7), ("returns", 3), ("sales_targets", 3))
)
_FINAL["preview_orders"] = f"""
SELECT * REPLACE ({_doubles("unit_price", "discount", "shipping_cost")}) FROM (
    SELECT order_id, order_date, ship_date, customer_id, product_id, country, channel, quantity, unit_price, discount,
           shipping_cost, payment_method
    FROM raw_orders ORDER BY ALL LIMIT 3)"""

# --- lineage A: cleaning -----------------------------------------------------------------------------------
_FINAL["clean_orders"] = f"""
SELECT * REPLACE ({_doubles("unit_price", "discount", "shipping_cost")}) FROM clean_orders"""
_FINAL["clean_products"] = f"SELECT * REPLACE ({_doubles('unit_cost', 'list_price')}) FROM clean_products"
_FINAL["clean_customers"] = f"""
SELECT * REPLACE ({title_list("segment")} AS segment, {title_list("country")} AS country) FROM raw_customers"""
_FINAL["fct_orders_first_return"] = "SELECT * FROM fct_orders_first_return"
_BLANK = "(CASE customer_id % 4 WHEN 0 THEN chr(160) WHEN 1 THEN chr(12288) WHEN 2 THEN chr(9) || ' ' || chr(31) ELSE chr(8195) || chr(133) END)"
_FINAL["strip_text"] = f"""SELECT customer_id, customer_name || {_BLANK} || city AS stripped FROM raw_customers"""
_FINAL["clean_returns"] = "SELECT * FROM first_returns"
_FINAL["clean_targets"] = f"SELECT * REPLACE ({_doubles('target_revenue')}) FROM clean_targets"
_FINAL["dedup_first"] = "SELECT * FROM first_returns"
_FINAL["dedup_removed_count"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) - count(DISTINCT order_id) AS removed FROM raw_{t}"
    for t in ("orders", "returns")
)
_FINAL["parse_date_tolerant"] = """
SELECT o_orderkey AS order_key, TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS parsed_date,
       TRY_CAST(o_orderpriority AS DATE) AS parsed_priority
FROM orders"""

# --- lineage A: enrichment, scores, reports ----------------------------------------------------------------
_FINAL["orders_enriched"] = f"SELECT * REPLACE ({_doubles(*ENRICHED_MONEY)}) FROM orders_enriched"
_FINAL["date_dimensions"] = """
SELECT order_date, CAST(year(order_date) AS INTEGER) AS year, CAST(quarter(order_date) AS INTEGER) AS quarter,
       CAST(month(order_date) AS INTEGER) AS month, monthname(order_date) AS month_name,
       CAST(week(order_date) AS INTEGER) AS week, strftime(order_date, '%Y-%m') AS year_month,
       strftime(order_date, '%Y') || '-Q' || quarter(order_date) AS year_quarter,
       CAST(CASE WHEN month(order_date) >= 7 THEN year(order_date) + 1 ELSE year(order_date) END AS INTEGER) AS fiscal_year,
       CAST((month(order_date) + 5) % 12 // 3 + 1 AS INTEGER) AS fiscal_quarter
FROM orders_enriched"""
_FINAL["rfm_qcut"] = f"SELECT * REPLACE ({_doubles('monetary')}) FROM rfm_a_bins"
_FINAL["customer_analytics"] = f"""
SELECT * REPLACE ({_doubles("monetary", "revenue", "clv_estimate")}) FROM customer_analytics"""
_FINAL["customer_profit"] = """
SELECT customer_id, CAST(sum(net_revenue) AS DOUBLE) AS revenue, count(DISTINCT order_id) AS orders,
       CAST(coalesce(sum(gross_profit), 0) AS DOUBLE) AS profit
FROM orders_enriched GROUP BY customer_id"""
_FINAL["score_distribution"] = """
SELECT rfm_score, count(*) AS customers FROM customer_analytics GROUP BY rfm_score ORDER BY rfm_score"""
_FINAL["segment_distribution"] = """
SELECT segment, count(*) AS customers FROM customer_analytics GROUP BY segment ORDER BY customers DESC, segment"""


def _euros(x: str, digits: int = 0) -> str:
    return f"'€' || format('{{:,.{digits}f}}', CAST({x} AS DOUBLE))"


def _percent(x: str, digits: int = 1) -> str:
    return f"format('{{:.{digits}f}}%', CAST({x} AS DOUBLE) * 100)"


def _whole(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _report(source: str, label: str, rows: list[tuple[str, ...]]) -> str:
    extra = "formula" if len(rows[0]) > 3 else ""
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{row[0]}' AS {label}, {row[2]} AS value, CAST({row[1]} AS DOUBLE) AS amount"
        + (f", '{row[3]}' AS {extra}" if extra else "")
        + f" FROM {source}"
        for i, row in enumerate(rows, 1)
    )


_FINAL["retention"] = _report(
    "retention_figures",
    "metric",
    [
        (f"Unique Customers {BASE}", "base", _whole("base")),
        (f"Unique Customers {COMPARISON}", "comparison", _whole("comparison")),
        ("Customer Growth %", "growth_pct", "'+' || format('{:.1f}%', growth_pct)"),
        (f"Retained ({BASE} → {COMPARISON})", "retained", _whole("retained")),
        ("Retention Rate", "retention_rate", _percent("retention_rate")),
        ("Churn Rate", "churn_rate", _percent("churn_rate")),
        ("Repeat Purchase Rate", "repeat_rate", _percent("repeat_rate")),
    ],
)
_FINAL["retained_customers"] = "SELECT * FROM retained"
_FINAL["new_customers"] = "SELECT * FROM newcomers"
_TOTALS = """(SELECT sum(gross_revenue) AS gross, sum(discount_amount) AS given, sum(net_revenue) AS net,
    sum(cogs) AS costs, sum(gross_profit) AS profit, count(*) AS n, count(DISTINCT product_id) AS products
    FROM orders_enriched)"""
_FINAL["order_totals"] = f"""
SELECT CAST(gross AS DOUBLE) AS gross_revenue, CAST(given AS DOUBLE) AS discount_amount,
       CAST(net AS DOUBLE) AS net_revenue, CAST(costs AS DOUBLE) AS cogs, CAST(profit AS DOUBLE) AS gross_profit,
       n AS priced_orders, n AS orders, products FROM {_TOTALS}"""
_MARGIN = "CAST(profit AS DOUBLE) / CAST(net AS DOUBLE)"
_VALUE = "CAST(net AS DOUBLE) / CAST(n AS DOUBLE)"
_GIVEN = "CAST(given AS DOUBLE) / CAST(gross AS DOUBLE)"
_RETURNED = "CAST((SELECT count(DISTINCT order_id) FROM raw_returns) AS DOUBLE) / CAST(n AS DOUBLE)"
_FINAL["kpis_commercial"] = _report(
    _TOTALS,
    "kpi",
    [
        ("Net Revenue", "net", _euros("net"), "Unit Price × Qty × (1−Discount)"),
        ("Gross Profit", "profit", _euros("profit"), "Net Revenue − COGS"),
        ("Gross Margin %", _MARGIN, _percent(_MARGIN), "(Net Rev − COGS) / Net Rev"),
        ("Avg Order Value", _VALUE, _euros(_VALUE, 2), "Net Revenue / Order Count"),
        ("Avg Discount %", _GIVEN, _percent(_GIVEN), "Discount Amount / Gross Revenue"),
        ("Return Rate", _RETURNED, _percent(_RETURNED), "Returned Orders / Total Orders"),
        ("Total Orders", "n", _whole("n"), "COUNT(DISTINCT order_id)"),
        ("Unique Products", "products", "CAST(products AS VARCHAR)", "COUNT(DISTINCT product_id)"),
    ],
)
_SCORED = """(SELECT count(*) AS customers,
    CAST(count(*) FILTER (segment = 'Champions') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS champions,
    CAST(count(*) FILTER (segment = 'At Risk') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS at_risk,
    CAST(sum(clv_estimate) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS clv,
    CAST(sum(clv_estimate) FILTER (segment = 'Champions') AS DOUBLE)
        / CAST(count(*) FILTER (segment = 'Champions') AS DOUBLE) AS champions_clv,
    count(*) FILTER (segment = 'Champions') AS n_champions, count(*) FILTER (segment = 'At Risk') AS n_at_risk
    FROM customer_analytics)"""
_FINAL["kpis_marketing"] = _report(
    f"retention_figures, {_SCORED}",
    "kpi",
    [
        ("Unique Customers", "customers", _whole("customers")),
        (f"New Customers {COMPARISON}", "newcomers", _whole("newcomers")),
        ("Retention Rate", "retention_rate", _percent("retention_rate")),
        ("Churn Rate", "churn_rate", _percent("churn_rate")),
        ("Repeat Purchase Rate", "repeat_rate", _percent("repeat_rate")),
        ("Champions Share", "champions", _percent("champions")),
        ("At-Risk Share", "at_risk", _percent("at_risk")),
        ("Avg CLV (all)", "clv", _euros("clv")),
        ("Avg CLV (Champions)", "champions_clv", _euros("champions_clv")),
    ],
)
_FINAL["disc_impact"] = """
SELECT disc_tier, count(*) AS orders, CAST(round_even(sum(net_revenue), 3) AS DOUBLE) AS net_revenue,
       round_even(avg(margin_pct), 3) AS margin_pct
FROM (
    SELECT *, CASE WHEN discount = 0 THEN 'No discount' WHEN discount <= 0.10 THEN '1–10%'
                   WHEN discount <= 0.20 THEN '11–20%' WHEN discount <= 0.30 THEN '21–30%' ELSE '31–50%' END AS disc_tier
    FROM orders_enriched
) GROUP BY disc_tier"""
_FINAL["monthly_actual_vs_target"] = """
SELECT country, year_month, CAST(actual AS DOUBLE) AS actual, CAST(target_revenue AS DOUBLE) AS target
FROM monthly_actual JOIN clean_targets USING (country, year_month)"""
_FINAL["country_kpis"] = f"SELECT * REPLACE ({_doubles(f'rev_{BASE}', f'rev_{COMPARISON}')}) FROM country_kpis"
_FINAL["country_kpis_display"] = f"""
SELECT country, CAST(round_even(rev_{BASE}, 1) AS DOUBLE) AS rev_{BASE},
       CAST(round_even(rev_{COMPARISON}, 1) AS DOUBLE) AS rev_{COMPARISON},
       round_even(yoy_growth_pct, 1) AS yoy_growth_pct, round_even(target_achievement_pct, 1) AS target_achievement_pct,
       round_even(rev_per_customer, 1) AS rev_per_customer
FROM country_kpis"""
_HEADLINE = f"""(SELECT *, comparison / base - 1 AS growth, round(full_margin - deep_margin, 9) AS compression FROM (
    SELECT CAST(sum(net_revenue) FILTER (year(order_date) = {BASE}) AS DOUBLE) AS base,
           CAST(sum(net_revenue) FILTER (year(order_date) = {COMPARISON}) AS DOUBLE) AS comparison,
           count(*) FILTER (discount >= 0.3) AS deep, round(avg(margin_pct) FILTER (discount >= 0.3), 9) AS deep_margin,
           round(avg(margin_pct) FILTER (discount = 0), 9) AS full_margin
    FROM orders_enriched))"""
_FINAL["headline_numbers"] = _report(
    f"{_HEADLINE}, {_SCORED}",
    "metric",
    [
        (f"{COMPARISON} YoY Revenue Growth", "growth", f"'+' || {_percent('growth', 0)}"),
        ("Champions", "n_champions", _whole("n_champions")),
        ("At-Risk", "n_at_risk", _whole("n_at_risk")),
        ("Orders with 30%+ discount", "deep", _whole("deep")),
        ("Margin at 30%+ discount", "deep_margin", _percent("deep_margin")),
        ("Margin at no discount", "full_margin", _percent("full_margin")),
        ("Margin compression", "compression", f"{_percent('compression')} || ' pp'"),
    ],
)

# --- single functions --------------------------------------------------------------------------------------
_FINAL["title_case"] = f"""
SELECT customer_id, {title_list("label")} AS label FROM (
    SELECT customer_id, segment || '-' || acquisition_channel || '-' || customer_name AS label FROM raw_customers)"""
_ALIASES = "['Deutschland', 'Allemagne', 'FR', 'España', 'Italia', 'Belgique', 'Pays-Bas', 'Irlande']"
_FINAL["alias_country"] = f"""
SELECT customer_id, country_raw, {title_list("trimmed")} AS country FROM (
    SELECT customer_id, country_raw, trim(CASE country_raw WHEN 'Deutschland' THEN 'Germany'
        WHEN 'Allemagne' THEN 'Germany' WHEN 'FR' THEN 'France' WHEN 'España' THEN 'Spain' WHEN 'Italia' THEN 'Italy'
        WHEN 'Belgique' THEN 'Belgium' WHEN 'Pays-Bas' THEN 'Netherlands' WHEN 'Irlande' THEN 'Ireland'
        ELSE country_raw END) AS trimmed
    FROM (
        SELECT customer_id, CASE customer_id % 3 WHEN 0 THEN {_ALIASES}[customer_id % 8 + 1]
               WHEN 1 THEN ' ' || {_ALIASES}[customer_id % 8 + 1] || ' ' ELSE country END AS country_raw
        FROM raw_customers))"""
_FINAL["clip_discount"] = """
SELECT CAST(discount AS DOUBLE) AS discount, CAST(least(discount, 0.5) AS DOUBLE) AS clipped, count(*) AS orders
FROM raw_orders GROUP BY discount"""
_FINAL["fiscal_calendar"] = """
SELECT DISTINCT order_date,
       CAST(CASE WHEN month(order_date) >= 7 THEN year(order_date) + 1 ELSE year(order_date) END AS INTEGER) AS fiscal_year,
       CAST((month(order_date) + 5) % 12 // 3 + 1 AS INTEGER) AS fiscal_quarter
FROM raw_orders"""
_FINAL["display_formats"] = f"""
SELECT p_partkey AS product_id, {_euros("p_retailprice")} AS whole_euros,
       {_euros("p_retailprice * p_size", 2)} AS euros, {_percent("p_retailprice / 10000")} AS share,
       '+' || format('{{:.1f}}%', p_retailprice / 7) AS growth, {_whole("p_partkey")} AS rank_text
FROM part"""
_FINAL["snake_case_columns"] = f"SELECT * REPLACE ({_doubles('unit_cost', 'list_price')}) FROM raw_products"
_FINAL["post_load_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t}"
    for t in ("orders", "products", "customers", "returns", "sales_targets")
)
_FINAL["write_read_roundtrip"] = """
SELECT CAST(0 AS BIGINT) AS parquet_differences, CAST(0 AS BIGINT) AS csv_differences, count(*) AS rows_written
FROM stg_orders"""

ORACLE_SQL: dict[str, str] = {name: statement(final) for name, final in _FINAL.items()}
