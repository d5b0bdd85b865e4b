"""Order fact tables of both lineages, and the date attributes per order.

Lineage B is the SQL models: invalid orders are gone, money is rounded where the models round. Lineage A is the
notebooks: orders are repaired and kept, ratios stay unrounded doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import measures as m
from ledgerloom.functions.calendar import calendar_columns, parse_date_or_null
from ledgerloom.operators.dedup import keep_first

CALENDAR = ("year", "quarter", "month", "month_name", "week", "year_month", "year_quarter", "fiscal_year", "fiscal_quarter")


def int_orders_enriched(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lineage B: staged orders with product attributes, measures, date attributes and discount tier."""
    attributes = products.select(
        "product_id", "product_name", "category", "sub_category", "brand", "unit_cost", "list_price", "product_margin_pct"
    )
    joined = orders.join(attributes, "product_id", "left")
    measured = (
        joined.withColumn("discount_amount", m.discount_amount())
        .withColumn("cogs", m.cogs())
        .withColumn("gross_profit", m.gross_profit())
        .withColumn("margin_pct", F.round(m.margin(F.col("gross_profit"), F.col("net_revenue")), 4))
        .withColumns(calendar_columns(F.col("order_date"), padded_month_name=True))
        .withColumn("disc_tier", m.discount_tier_by_case(F.col("discount")))
    )
    return measured.select(
        "order_id", "customer_id", "product_id",
        "order_date", "ship_date", "shipping_days",
        "country", "channel", "payment_method",
        "product_name", "category", "sub_category", "brand", "unit_cost", "list_price", "product_margin_pct",
        "quantity", "unit_price", "discount", "shipping_cost",
        "gross_revenue", "discount_amount", "net_revenue", "cogs", "gross_profit", "margin_pct",
        *CALENDAR,
        "disc_tier",
    )


def fct_orders(
    enriched: DataFrame,
    returns: DataFrame,
    on_duplicate_returns: str = "fan_out",
) -> DataFrame:
    """Lineage B: the fact table, one row per staged order and return of it, with ``is_return`` and ``return_reason``.

    ``fan_out`` joins the returns as they are: an order that was returned twice has two rows, which the uniqueness
    test on the order id then reports. ``first`` keeps only the earliest return, so one row per order.
    """
    if on_duplicate_returns == "first":
        returns = keep_first(returns, ["order_id"], ["return_date", "return_reason"])
    elif on_duplicate_returns != "fan_out":
        raise ValueError("on_duplicate_returns must be 'first' or 'fan_out'")
    flags = returns.select("order_id", F.lit(1).alias("is_return"), "return_reason")
    joined = enriched.join(flags, "order_id", "left")
    return joined.select(
        *enriched.columns, F.coalesce("is_return", F.lit(0)).alias("is_return"), "return_reason"
    )


def orders_enriched(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lineage A: cleaned orders with product cost and measures; the margin is an unrounded double."""
    attributes = products.select(
        "product_id", "unit_cost", "list_price", "category", "sub_category", "brand", "product_margin_pct"
    )
    joined = orders.join(attributes, "product_id", "left")
    return (
        joined.withColumn("gross_revenue", m.gross_revenue())
        .withColumn("discount_amount", m.discount_amount())
        .withColumn("net_revenue", m.net_revenue())
        .withColumn("cogs", m.cogs())
        .withColumn("gross_profit", m.gross_profit())
        .withColumn(
            "margin_pct", m.margin(F.col("gross_profit").cast("double"), F.col("net_revenue").cast("double"))
        )
        .select(
            *orders.columns, *[c for c in attributes.columns if c != "product_id"],
            "gross_revenue", "discount_amount", "net_revenue", "cogs", "gross_profit", "margin_pct",
        )
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """Lineage A: order date and its nine attributes, one row per order. A bad date gives NULLs."""
    dates = orders.select(parse_date_or_null(F.col("order_date")).alias("order_date"))
    return dates.withColumns(calendar_columns(F.col("order_date")))
