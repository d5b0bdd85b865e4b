"""Staging models: types, names and the rules that drop invalid orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.config import COST, DISCOUNT, MONEY, PRICE, RetailConfig
from ledgerloom.functions.measures import dec, gross_revenue, net_revenue, product_margin


def to_int(df: DataFrame, name: str) -> Column:
    """Integer cast that rounds halves away from zero, as SQL databases do, instead of truncating."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("int")
    return F.round(F.col(name).cast("decimal(20,6)"), 0).cast("int")


def stg_orders(raw: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Valid orders, typed. The rules are stated on the stored columns, so that the scan can apply them."""
    valid = raw.where(
        F.col("discount").between(dec("0"), dec(config.max_discount))
        & (F.col("unit_price") > 0)
        & to_int(raw, "quantity").between(1, 5)
        & (F.col("ship_date").cast("date") >= F.col("order_date").cast("date"))
    )
    typed = valid.select(
        "order_id",
        "customer_id",
        "product_id",
        F.col("order_date").cast("date"),
        F.col("ship_date").cast("date"),
        "country",
        "channel",
        "payment_method",
        to_int(raw, "quantity").alias("quantity"),
        F.col("unit_price").cast(PRICE),
        F.col("discount").cast(DISCOUNT),
        F.col("shipping_cost").cast(PRICE),
    )
    return typed.withColumns(
        {
            "shipping_days": F.datediff("ship_date", "order_date"),
            "gross_revenue": gross_revenue(),
            "net_revenue": net_revenue(),
        }
    )


def stg_products(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        "product_id",
        "product_name",
        "category",
        F.col("`sub-category`").alias("sub_category"),
        "brand",
        F.col("unit_cost").cast(COST),
        F.col("list_price").cast(PRICE),
        F.col("launch_date").cast("date"),
    )
    return typed.withColumn("product_margin_pct", F.round(product_margin(), 4))


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_name",
        "segment",
        "country",
        "city",
        F.col("acquisition_date").cast("date"),
        "acquisition_channel",
    )


def stg_returns(raw: DataFrame) -> DataFrame:
    return raw.select("order_id", F.col("return_date").cast("date"), F.col("reason").alias("return_reason"))


def stg_sales_targets(raw: DataFrame) -> DataFrame:
    month_text = F.col("`year-month`")
    return raw.select(
        "country",
        month_text.alias("year_month"),
        F.split_part(month_text, F.lit("-"), F.lit(1)).cast("int").alias("year"),
        F.split_part(month_text, F.lit("-"), F.lit(2)).cast("int").alias("month"),
        F.col("target_revenue").cast(MONEY),
    )
