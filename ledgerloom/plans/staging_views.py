"""The staging models as persistent catalog views, bound to SQL text over the raw tables.

A view is read by every session of the catalog and computed on each read. The text says what the functions in
``staging`` say; the tests hold one against the other.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerloom.config import COST, DISCOUNT, MONEY, PRICE, RetailConfig
from ledgerloom.sinks.warehouse import create_databases, model_table_name, write_view

STAGING = ("stg_orders", "stg_products", "stg_customers", "stg_returns", "stg_sales_targets")


def view_sql(raw: str, config: RetailConfig = RetailConfig()) -> dict[str, str]:
    """The defining SELECT of each staging model; ``raw`` is the database of the raw tables."""
    whole = "cast(round(cast(quantity AS decimal(20,6)), 0) AS int)"
    return {
        "stg_orders": f"""
            SELECT *, datediff(ship_date, order_date) AS shipping_days,
                   cast(unit_price * quantity AS {MONEY}) AS gross_revenue,
                   cast(unit_price * quantity * (1 - discount) AS {MONEY}) AS net_revenue
            FROM (
                SELECT order_id, customer_id, product_id, cast(order_date AS date) AS order_date, cast(ship_date AS date) AS ship_date,
                       country, channel, payment_method, {whole} AS quantity, cast(unit_price AS {PRICE}) AS unit_price,
                       cast(discount AS {DISCOUNT}) AS discount, cast(shipping_cost AS {PRICE}) AS shipping_cost
                FROM {raw}.orders
                WHERE discount BETWEEN 0 AND {config.max_discount} AND unit_price > 0 AND {whole} BETWEEN 1 AND 5
                      AND cast(ship_date AS date) >= cast(order_date AS date)
            )""",
        "stg_products": f"""
            SELECT *, round((list_price - unit_cost) / nullif(list_price, 0), 4) AS product_margin_pct
            FROM (
                SELECT product_id, product_name, category, `sub-category` AS sub_category, brand,
                       cast(unit_cost AS {COST}) AS unit_cost, cast(list_price AS {PRICE}) AS list_price,
                       cast(launch_date AS date) AS launch_date
                FROM {raw}.products
            )""",
        "stg_customers": f"""
            SELECT customer_id, customer_name, segment, country, city, cast(acquisition_date AS date) AS acquisition_date,
                   acquisition_channel
            FROM {raw}.customers""",
        "stg_returns": f"""
            SELECT order_id, cast(return_date AS date) AS return_date, reason AS return_reason FROM {raw}.returns""",
        "stg_sales_targets": f"""
            SELECT country, `year-month` AS year_month, cast(split_part(`year-month`, '-', 1) AS int) AS year,
                   cast(split_part(`year-month`, '-', 2) AS int) AS month, cast(target_revenue AS {MONEY}) AS target_revenue
            FROM {raw}.sales_targets""",
    }


def create_staging_views(spark: SparkSession, raw: str = "raw", layer: str = "staging", config: RetailConfig = RetailConfig()) -> dict[str, str]:
    """Create or replace the five views in the database of their layer; returns their full names by model."""
    create_databases(spark, [layer])
    names = {model: model_table_name(layer, model) for model in STAGING}
    for model, sql in view_sql(raw, config).items():
        write_view(spark, names[model], sql)
    return names
