"""Order measures, ratios, discount tiers and customer segments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.config import BINNED_TIERS, MONEY, RFM_SEGMENTS, SQL_TIERS


def dec(value: str) -> Column:
    """A decimal literal; a float literal would turn comparisons into double ones."""
    digits = len(value.partition(".")[2])
    return F.lit(value).cast(f"decimal({max(len(value), digits + 1)},{digits})")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL where the divisor is zero."""
    return numerator / F.nullif(denominator, F.lit(0).cast("int"))


def clip(c: Column, low: str, high: str) -> Column:
    """Limit to a range. NULL stays NULL, which ``greatest`` and ``least`` alone would not keep."""
    return F.when(c.isNotNull(), F.greatest(dec(low), F.least(dec(high), c)))


def is_true(condition: Column) -> Column:
    """A condition that is false, not NULL, where an input is missing."""
    return F.coalesce(condition, F.lit(False))


def gross_revenue() -> Column:
    return (F.col("unit_price") * F.col("quantity")).cast(MONEY)


def discount_amount() -> Column:
    return (F.col("unit_price") * F.col("quantity") * F.col("discount")).cast(MONEY)


def net_revenue() -> Column:
    return (F.col("unit_price") * F.col("quantity") * (1 - F.col("discount"))).cast(MONEY)


def cogs() -> Column:
    return (F.col("unit_cost") * F.col("quantity")).cast(MONEY)


def gross_profit() -> Column:
    return (F.col("net_revenue") - F.col("cogs")).cast(MONEY)


def margin(profit: Column, net: Column) -> Column:
    """Profit over net revenue, zero where there is no revenue, NULL where the cost is unknown."""
    return F.when(net > 0, profit / net).otherwise(F.lit(0))


def product_margin() -> Column:
    return ratio(F.col("list_price") - F.col("unit_cost"), F.col("list_price"))


def discount_tier_by_case(discount: Column) -> Column:
    """Tier labels of the SQL models. Everything that is no other tier, NULL included, is the last one."""
    return (
        F.when(discount == 0, SQL_TIERS[0])
        .when(discount <= dec("0.10"), SQL_TIERS[1])
        .when(discount <= dec("0.20"), SQL_TIERS[2])
        .when(discount <= dec("0.30"), SQL_TIERS[3])
        .otherwise(SQL_TIERS[4])
    )


def discount_tier_by_bins(discount: Column) -> Column:
    """Tier labels by right-closed bins from -0.01 to 0.5; NULL outside of them."""
    return (
        F.when(discount <= dec("-0.01"), None)
        .when(discount <= 0, BINNED_TIERS[0])
        .when(discount <= dec("0.10"), BINNED_TIERS[1])
        .when(discount <= dec("0.20"), BINNED_TIERS[2])
        .when(discount <= dec("0.30"), BINNED_TIERS[3])
        .when(discount <= dec("0.50"), BINNED_TIERS[4])
    )


def rfm_segment(score: Column) -> Column:
    return (
        F.when(score >= 13, RFM_SEGMENTS[0])
        .when(score >= 10, RFM_SEGMENTS[1])
        .when(score >= 7, RFM_SEGMENTS[2])
        .when(score >= 4, RFM_SEGMENTS[3])
        .otherwise(RFM_SEGMENTS[4])
    )
