"""Business constants, as one immutable object that every plan receives."""

from __future__ import annotations

from dataclasses import dataclass, field

# Results depend on these names and limits.
COUNTRIES = ("France", "Germany", "Italy", "Spain", "Portugal", "Netherlands", "Belgium", "Ireland")
CATEGORIES = ("Apparel", "Footwear", "Accessories", "Home & Living", "Beauty")
CHANNELS = ("Web", "Mobile App", "Marketplace")
SEGMENTS = ("Consumer", "Business", "Premium")
PAYMENT_METHODS = ("Credit Card", "PayPal", "Bank Transfer", "Apple Pay", "Klarna")
ACQUISITION_CHANNELS = ("Paid Search", "Organic Search", "Direct", "Email", "Social", "Referral")
COUNTRY_ALIASES = {
    "Deutschland": "Germany",
    "Allemagne": "Germany",
    "FR": "France",
    "España": "Spain",
    "Italia": "Italy",
    "Belgique": "Belgium",
    "Pays-Bas": "Netherlands",
    "Irlande": "Ireland",
}
RFM_SEGMENTS = ("Champions", "Loyal Customers", "Potential Loyalists", "Needs Attention", "At Risk")
SQL_TIERS = ("No discount", "1-10%", "11-20%", "21-30%", "31-50%")
BINNED_TIERS = ("No discount", "1–10%", "11–20%", "21–30%", "31–50%")

# Money is decimal from end to end, so that sums do not depend on the order in which tasks finish.
# price(2 digits) x quantity x discount(4 digits) needs 6 digits and stays within 18.
PRICE = "decimal(12,2)"
COST = "decimal(14,4)"
DISCOUNT = "decimal(6,4)"
MONEY = "decimal(18,6)"


@dataclass(frozen=True)
class RetailConfig:
    """Dates, years and accepted values. The defaults are those of the original data set."""

    snapshot_date: str = "2026-01-01"
    base_year: int = 2024
    comparison_year: int = 2025
    clv_factor: str = "1.5"
    max_discount: str = "0.5"
    deep_discount: str = "0.3"
    countries: tuple[str, ...] = COUNTRIES
    categories: tuple[str, ...] = CATEGORIES
    channels: tuple[str, ...] = CHANNELS
    segments: tuple[str, ...] = SEGMENTS
    payment_methods: tuple[str, ...] = PAYMENT_METHODS
    acquisition_channels: tuple[str, ...] = ACQUISITION_CHANNELS
    country_aliases: dict[str, str] = field(default_factory=lambda: dict(COUNTRY_ALIASES))
