"""Marts of lineage B."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerloom.config import RetailConfig
from ledgerloom.functions.calendar import fiscal_quarter_of, fiscal_year_of
from ledgerloom.functions.measures import ratio


def total_orders_by_month(fct: DataFrame) -> DataFrame:
    return fct.groupBy("year_month").agg(F.count("*").alias("total_orders")).orderBy("year_month")


def _rounded(c: Column, digits: int, name: str) -> Column:
    return F.round(c, digits).alias(name)


def sums_and_counts(fct: DataFrame, keys: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Per group: the sums (column to name), ``rows``, distinct orders as ``orders``, distinct customers as ``customers``.

    Distinct counts side by side would copy every row once for each. Instead rows meet by group and order id, where
    sorting marks one row of each order, so that it counts once even if it names two customers; then each step leaves
    fewer rows: by group and customer, then by group. No step holds the same rows in more than one sort and one hash table.
    """
    first = [F.sum(column).alias(name) for column, name in sums.items()]
    met = fct.repartition(*keys, "order_id")
    once = F.row_number().over(Window.partitionBy(*keys, "order_id").orderBy("customer_id")) == 1
    marked = met.withColumn("known", F.when(once & F.col("order_id").isNotNull(), 1).otherwise(0))
    per_customer = marked.groupBy(*keys, "customer_id").agg(F.sum("known").alias("orders"), *first, F.count("*").alias("rows"))

    def total(name: str) -> Column:
        # Spark rounds a quotient by the width of its decimals; they are as wide as a sum of sums of sums.
        kind = per_customer.schema[name].dataType
        wide = isinstance(kind, T.DecimalType)
        return (F.sum(name).cast(T.DecimalType(min(kind.precision + 20, 38), kind.scale)) if wide else F.sum(name)).alias(name)

    return per_customer.groupBy(*keys).agg(total("orders"), F.count("customer_id").alias("customers"), *[total(n) for n in (*sums.values(), "rows")])


def mart_commercial_kpis(fct: DataFrame) -> DataFrame:
    """Commercial measures by month, country, channel, category, sub-category, brand and discount tier.

    Quarter, fiscal year and the text forms of the month follow from year and month, so they are computed from
    the groups instead of being shuffled with every row.
    """
    dimensions = ["country", "channel", "category", "sub_category", "brand", "disc_tier"]
    keys = ["year", "month", *dimensions]
    # Only what cannot be derived is summed: the discount amount is gross less net, and staged measures are never NULL.
    summed = {"quantity": "total_units", "gross_revenue": "gross", "net_revenue": "net", "cogs": "costs", "gross_profit": "profit", "discount": "discounts", "is_return": "total_returns"}
    groups = sums_and_counts(fct, keys, summed).withColumnsRenamed({"orders": "total_orders", "customers": "unique_customers"})
    c = F.col
    quarter = F.ceil(c("month") / 3).cast("int")
    year_text = c("year").cast("string")
    given = c("gross") - c("net")
    return groups.select(
        "year",
        quarter.alias("quarter"),
        "month",
        F.concat(year_text, F.lit("-"), F.lpad(c("month").cast("string"), 2, "0")).alias("year_month"),
        F.concat(year_text, F.lit("-Q"), quarter.cast("string")).alias("year_quarter"),
        fiscal_year_of(c("year"), c("month")).alias("fiscal_year"),
        fiscal_quarter_of(c("month")).alias("fiscal_quarter"),
        *dimensions,
        "total_orders",
        "total_units",
        "unique_customers",
        _rounded(c("gross"), 2, "gross_revenue"),
        _rounded(given, 2, "total_discount"),
        _rounded(c("net"), 2, "net_revenue"),
        _rounded(ratio(c("net"), c("rows")), 2, "avg_order_value"),
        _rounded(c("costs"), 2, "total_cogs"),
        _rounded(c("profit"), 2, "gross_profit"),
        _rounded(ratio(c("profit"), c("net")), 4, "blended_margin_pct"),
        _rounded(ratio(c("discounts"), c("rows")), 4, "avg_discount_pct"),
        _rounded(ratio(given, c("gross")), 4, "discount_share_of_gross"),
        "total_returns",
        _rounded(ratio(c("total_returns").cast("decimal(20,0)"), c("rows")), 4, "return_rate"),
    )


def mart_customer_kpis(customers: DataFrame, rfm: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Customer master data with scores and value estimate; customers without orders have NULLs there."""
    master = customers.withColumnRenamed("segment", "customer_segment")
    scores = (
        rfm.withColumnRenamed("segment", "rfm_segment")
        .withColumnRenamed("revenue", "total_revenue")
        .withColumnRenamed("orders", "total_orders")
    )
    tenure = F.datediff(F.lit(config.snapshot_date).cast("date"), "acquisition_date")
    return master.join(scores, "customer_id", "left").select(
        "customer_id", "customer_name", "customer_segment", "country", "city", "acquisition_date", "acquisition_channel",
        "recency", "frequency", "monetary", "r", "f", "m", "rfm_score", "rfm_segment",
        "total_revenue", "total_orders", "clv_estimate", "first_order_date", "last_order_date",
        tenure.alias("tenure_days"),
    )


def mart_country_targets(fct: DataFrame, targets: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Actual revenue and target per country and month.

    Two columns keep names that promise something else: ``target_achievement_pct`` is actual minus target, and
    the yearly revenues behind the growth are those of the best month of each year.
    """
    actuals = sums_and_counts(fct, ["country", "year_month", "year"], {"net_revenue": "actual_revenue"}).drop("rows")
    joined = actuals.join(
        targets.select("country", "year_month", "target_revenue"), ["country", "year_month"], "left"
    ).select(
        "country",
        "year_month",
        "year",
        "actual_revenue",
        "orders",
        "customers",
        "target_revenue",
        F.round(F.col("actual_revenue") - F.col("target_revenue"), 2).alias("target_achievement_pct"),
    )
    base, comparison = f"rev_{config.base_year}", f"rev_{config.comparison_year}"
    # One row per country and month is left here, so the window is small whatever the number of orders.
    per_country = Window.partitionBy("country")

    def best_month(year: int) -> Column:
        best = F.max(F.when(F.col("year") == year, F.col("actual_revenue"))).over(per_country)
        return F.when(F.col("country").isNotNull(), best)

    growth = ratio((F.col(comparison) - F.col(base)), F.col(base)) * 100
    return (
        joined.withColumn(base, best_month(config.base_year))
        .withColumn(comparison, best_month(config.comparison_year))
        .withColumn("yoy_growth_pct", F.round(growth, 2))
    )
