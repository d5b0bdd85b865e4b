"""Cleaners of lineage A: repair and keep, one function per raw table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.config import COST, DISCOUNT, MONEY, PRICE, RetailConfig
from ledgerloom.functions.measures import clip, product_margin
from ledgerloom.functions.text import replace_exact, strip, title_case
from ledgerloom.operators.dedup import keep_first


def _country(config: RetailConfig) -> Column:
    """Aliases are matched before blanks are removed, so an alias with blanks around it is not recognised."""
    return title_case(strip(replace_exact(F.col("country"), config.country_aliases)))


def clean_orders(
    raw: DataFrame, config: RetailConfig = RetailConfig(), arrival: Sequence[str] | None = None
) -> DataFrame:
    """``arrival`` names the columns that tell which of two rows with one order id came first."""
    typed = raw.withColumns(
        {
            "order_date": F.col("order_date").cast("date"),
            "ship_date": F.col("ship_date").cast("date"),
            "unit_price": F.col("unit_price").cast(PRICE),
            "discount": F.col("discount").cast(DISCOUNT),
            "shipping_cost": F.col("shipping_cost").cast(PRICE),
        }
    )
    # De-duplicate first: each row is cleaned on its own, so the survivor is the same and fewer are cleaned.
    return keep_first(typed, ["order_id"], arrival).withColumns(
        {
            "country": _country(config),
            "discount": clip(F.col("discount"), "0", config.max_discount).cast(DISCOUNT),
            "shipping_days": F.datediff("ship_date", "order_date"),
        }
    )


def clean_products(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumnRenamed("sub-category", "sub_category").withColumns(
        {
            "launch_date": F.col("launch_date").cast("date"),
            "category": title_case(strip(F.col("category"))),
            "brand": strip(F.col("brand")),
            "unit_cost": F.col("unit_cost").cast(COST),
            "list_price": F.col("list_price").cast(PRICE),
        }
    )
    return cleaned.withColumn("product_margin_pct", product_margin().cast("double"))


def clean_customers(raw: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    return raw.withColumns(
        {
            "acquisition_date": F.col("acquisition_date").cast("date"),
            "segment": title_case(strip(F.col("segment"))),
            "country": _country(config),
            "acquisition_channel": strip(F.col("acquisition_channel")),
        }
    )


def clean_returns(raw: DataFrame, arrival: Sequence[str] | None = None) -> DataFrame:
    typed = raw.withColumn("return_date", F.col("return_date").cast("date"))
    return keep_first(typed, ["order_id"], arrival).withColumn("reason", strip(F.col("reason")))


def clean_targets(raw: DataFrame) -> DataFrame:
    """Aliases are not replaced here, only blanks and letter case."""
    month_text = F.col("`year-month`")
    return raw.select(
        title_case(strip(F.col("country"))).alias("country"),
        month_text.alias("year_month"),
        F.col("target_revenue").cast(MONEY),
        F.split_part(month_text, F.lit("-"), F.lit(1)).cast("int").alias("year"),
        F.split_part(month_text, F.lit("-"), F.lit(2)).cast("int").alias("month"),
    )
