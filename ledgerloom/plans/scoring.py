"""Recency, frequency and monetary scores, segments and lifetime value, in both lineages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.config import RetailConfig
from ledgerloom.functions.measures import dec, rfm_segment
from ledgerloom.operators.ranking import bins_by_quantile, tile_by_rank

SCORES = {"r": "recency", "f": "frequency", "m": "monetary"}


def rfm_base(orders: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """One row per customer: days since the last order, distinct orders, net revenue, first and last date.

    Scores and lifetime value share these numbers, so the orders are aggregated once.
    """
    last = F.max("order_date")
    return orders.groupBy("customer_id").agg(
        F.datediff(F.lit(config.snapshot_date).cast("date"), last).alias("recency"),
        F.count_distinct("order_id").alias("frequency"),
        F.coalesce(F.sum("net_revenue"), F.lit(0)).alias("monetary"),
        F.min("order_date").alias("first_order_date"),
        last.alias("last_order_date"),
    )


def _scored(base: DataFrame, suffix: str) -> DataFrame:
    """Turn ranks per measure into scores: 5 is best, so recency counts backwards."""
    return (
        base.withColumns({"r": 6 - F.col(f"r{suffix}"), "f": F.col(f"f{suffix}"), "m": F.col(f"m{suffix}")})
        .withColumn("rfm_score", F.col("r") + F.col("f") + F.col("m"))
        .withColumn("segment", rfm_segment(F.col("rfm_score")))
    )


def _measures() -> dict[str, Column]:
    return {score: F.col(measure) for score, measure in SCORES.items()}


def int_customer_rfm(enriched: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Lineage B: scores by rank, five tiles of equal size; equal values are split by customer id."""
    base = rfm_base(enriched, config).withColumn("monetary", F.round("monetary", 2))
    scored = _scored(tile_by_rank(base, "customer_id", _measures()), "_tile")
    return scored.select(
        "customer_id", "recency", "frequency", "monetary", "first_order_date", "last_order_date",
        "r", "f", "m", "rfm_score", "segment",
        F.col("monetary").alias("revenue"),
        F.col("frequency").alias("orders"),
        F.round(F.col("monetary") * dec(config.clv_factor), 2).alias("clv_estimate"),
    )


def customer_analytics(enriched: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Lineage A: scores by value, equal values together; revenue stays unrounded."""
    return analytics_of(rfm_base(enriched, config).drop("first_order_date", "last_order_date"), config)


def analytics_of_months(months: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """The same table from the state per customer, country and month."""
    last = F.max("last_order_date")
    base = months.groupBy("customer_id").agg(
        F.datediff(F.lit(config.snapshot_date).cast("date"), last).alias("recency"),
        F.sum("orders").alias("frequency"),
        # A sum of sums widens its type, and a product of it would lose digits.
        F.coalesce(F.sum("net_revenue"), F.lit(0)).cast("decimal(28,6)").alias("monetary"),
    )
    return analytics_of(base, config)


def analytics_of(base: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    scored = _scored(bins_by_quantile(base, _measures()), "_bin")
    return scored.select(
        "customer_id", "recency", "frequency", "monetary", "r", "f", "m", "rfm_score", "segment",
        F.col("monetary").alias("revenue"),
        F.col("frequency").alias("orders"),
        (F.col("monetary") * dec(config.clv_factor)).alias("clv_estimate"),
    )


def customer_profit(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("customer_id").agg(
        F.sum("net_revenue").alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.coalesce(F.sum("gross_profit"), F.lit(0)).alias("profit"),
    )


def score_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("rfm_score").agg(F.count("*").alias("customers")).orderBy("rfm_score")


def segment_distribution(scored: DataFrame) -> DataFrame:
    counts = scored.groupBy("segment").agg(F.count("*").alias("customers"))
    return counts.orderBy(F.col("customers").desc(), "segment")
