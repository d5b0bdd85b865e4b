"""Reports of lineage A. Every figure is a column; its text form stands next to it.

Names of metrics and formulas are fixed values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.config import RetailConfig
from ledgerloom.functions.calendar import year_month
from ledgerloom.functions.display import euros, percent, signed_percent, whole
from ledgerloom.functions.measures import dec, discount_tier_by_bins
from ledgerloom.operators.storage import materialise


def _share(part: Column, total: Column) -> Column:
    return F.try_divide(part.cast("double"), total.cast("double"))


def _report(totals: DataFrame, label: str, rows: list[tuple]) -> DataFrame:
    """One report row per (name, figure, text, extra columns), from a one-row frame."""
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias(label),
            text.alias("value"),
            figure.cast("double").alias("amount"),
            *extra,
        )
        for position, (name, figure, text, *extra) in enumerate(rows, 1)
    ]
    return totals.select(F.inline(F.array(*entries)))


def customer_months(enriched: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """The state that the customer, country and headline reports are rolled up from: a row per customer, country, month.

    Every figure adds up over months, countries and customers. Order ids are unique, as cleaning leaves them, so orders
    are counted once by counting rows. Reports that read the state more than once should get it stored.
    """
    deep, full_price = F.col("discount") >= dec(config.deep_discount), F.col("discount") == 0
    date = F.col("order_date")
    return enriched.groupBy("customer_id", "country", F.year(date).alias("year"), year_month(date).alias("year_month")).agg(
        F.count("order_id").alias("orders"),
        F.sum("net_revenue").alias("net_revenue"),
        F.max(date).alias("last_order_date"),
        F.count_if(deep).alias("deep_orders"),
        *[
            kind(F.when(condition, F.col("margin_pct"))).alias(f"{name}_{figure}")
            for name, condition in (("deep", deep), ("full_price", full_price))
            for figure, kind in (("margins", F.sum), ("margin_rows", F.count))
        ],
    )


def stored_customer_months(enriched: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """The state, computed once and kept in the shared folder: the orders are read here and nowhere else."""
    return materialise(customer_months(enriched, config))


def customer_years(months: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Per customer: active in the base year, active in the comparison year, orders.

    One aggregation answers who was active, who stayed and who is new; no set operation is needed.
    """
    year = F.col("year")
    return months.groupBy("customer_id").agg(
        F.coalesce(F.bool_or(year == config.base_year), F.lit(False)).alias("active_base"),
        F.coalesce(F.bool_or(year == config.comparison_year), F.lit(False)).alias("active_comparison"),
        F.sum("orders").alias("orders"),
    )


def retained_customers(months: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    return customer_years(months, config).where("active_base AND active_comparison").select("customer_id")


def new_customers(months: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Active in the comparison year and not in the base year, whatever the acquisition date says."""
    return customer_years(months, config).where("active_comparison AND NOT active_base").select("customer_id")


def retention_figures(months: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """One row with the counts and rates that the retention and the marketing report share."""
    both = F.col("active_base") & F.col("active_comparison")
    counts = customer_years(months, config).agg(
        F.count_if("active_base").alias("base_customers"),
        F.count_if("active_comparison").alias("comparison_customers"),
        F.count_if(both).alias("retained"),
        F.count_if(F.col("active_comparison") & ~F.col("active_base")).alias("new_customers"),
        _share(F.count_if(F.col("customer_id").isNotNull() & (F.col("orders") >= 2)), F.count("customer_id")).alias(
            "repeat_rate"
        ),
    )
    rate = _share(F.col("retained"), F.col("base_customers"))
    gained = F.col("comparison_customers") - F.col("base_customers")
    return counts.withColumns(
        {
            "retention_rate": rate,
            "churn_rate": 1 - rate,
            "growth_pct": _share(gained, F.col("base_customers")) * 100,
        }
    )


def retention(months: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    base, comparison = config.base_year, config.comparison_year
    c = F.col
    return _report(
        retention_figures(months, config),
        "metric",
        [
            (f"Unique Customers {base}", c("base_customers"), whole(c("base_customers"))),
            (f"Unique Customers {comparison}", c("comparison_customers"), whole(c("comparison_customers"))),
            ("Customer Growth %", c("growth_pct"), signed_percent(c("growth_pct"))),
            (f"Retained ({base} → {comparison})", c("retained"), whole(c("retained"))),
            ("Retention Rate", c("retention_rate"), percent(c("retention_rate"))),
            ("Churn Rate", c("churn_rate"), percent(c("churn_rate"))),
            ("Repeat Purchase Rate", c("repeat_rate"), percent(c("repeat_rate"))),
        ],
    )


def order_totals(enriched: DataFrame) -> DataFrame:
    """One row of sums over all orders."""
    sums = ("gross_revenue", "discount_amount", "net_revenue", "cogs", "gross_profit")
    return enriched.agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count("net_revenue").alias("priced_orders"),
        F.count("*").alias("orders"),
        F.count_distinct("product_id").alias("products"),
    )


def kpis_commercial(enriched: DataFrame, returns: DataFrame) -> DataFrame:
    """Returned orders are counted in the returns table on its own, without a join to the orders."""
    returned = returns.agg(F.count_distinct("order_id")).scalar()
    c = F.col
    totals = order_totals(enriched).withColumns(
        {
            "margin": _share(c("gross_profit"), c("net_revenue")),
            "order_value": _share(c("net_revenue"), c("priced_orders")),
            "discount_share": _share(c("discount_amount"), c("gross_revenue")),
            "return_rate": _share(returned, c("orders")),
        }
    )
    rows = [
        ("Net Revenue", c("net_revenue"), euros(c("net_revenue")), "Unit Price × Qty × (1−Discount)"),
        ("Gross Profit", c("gross_profit"), euros(c("gross_profit")), "Net Revenue − COGS"),
        ("Gross Margin %", c("margin"), percent(c("margin")), "(Net Rev − COGS) / Net Rev"),
        ("Avg Order Value", c("order_value"), euros(c("order_value"), 2), "Net Revenue / Order Count"),
        ("Avg Discount %", c("discount_share"), percent(c("discount_share")), "Discount Amount / Gross Revenue"),
        ("Return Rate", c("return_rate"), percent(c("return_rate")), "Returned Orders / Total Orders"),
        ("Total Orders", c("orders"), whole(c("orders")), "COUNT(DISTINCT order_id)"),
        ("Unique Products", c("products"), c("products").cast("string"), "COUNT(DISTINCT product_id)"),
    ]
    return _report(totals, "kpi", [(n, a, v, F.lit(f).alias("formula")) for n, a, v, f in rows])


def kpis_marketing(months: DataFrame, analytics: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """``analytics`` is the scored customer table of the same orders."""
    champion = F.col("segment") == "Champions"
    scored = analytics.agg(
        F.struct(
            F.count("customer_id").alias("customers"),
            _share(F.count_if(champion), F.count("*")).alias("champions_share"),
            _share(F.count_if(F.col("segment") == "At Risk"), F.count("*")).alias("at_risk_share"),
            _share(F.sum("clv_estimate"), F.count("clv_estimate")).alias("clv"),
            _share(
                F.sum(F.when(champion, F.col("clv_estimate"))), F.count(F.when(champion, F.col("clv_estimate")))
            ).alias("champions_clv"),
        )
    ).scalar()
    totals = retention_figures(months, config).withColumn("scored", scored)
    c = F.col
    rows = [
        ("Unique Customers", c("scored.customers"), whole),
        (f"New Customers {config.comparison_year}", c("new_customers"), whole),
        ("Retention Rate", c("retention_rate"), percent),
        ("Churn Rate", c("churn_rate"), percent),
        ("Repeat Purchase Rate", c("repeat_rate"), percent),
        ("Champions Share", c("scored.champions_share"), percent),
        ("At-Risk Share", c("scored.at_risk_share"), percent),
        ("Avg CLV (all)", c("scored.clv"), euros),
        ("Avg CLV (Champions)", c("scored.champions_clv"), euros),
    ]
    return _report(totals, "kpi", [(name, figure, text(figure)) for name, figure, text in rows])


def disc_impact(enriched: DataFrame) -> DataFrame:
    """Orders, net revenue and mean row margin per discount tier; orders outside of the tiers are left out."""
    tier = discount_tier_by_bins(F.col("discount"))
    return (
        enriched.withColumn("disc_tier", tier)
        .where("disc_tier IS NOT NULL")
        .groupBy("disc_tier")
        .agg(
            F.count("order_id").alias("orders"),
            F.bround(F.sum("net_revenue"), 3).alias("net_revenue"),
            F.bround(F.avg("margin_pct"), 3).alias("margin_pct"),
        )
    )


def monthly_actual_vs_target(months: DataFrame, targets: DataFrame) -> DataFrame:
    """Net revenue and target per country and month; a month without a target is left out."""
    actual = months.groupBy("country", "year_month").agg(F.sum("net_revenue").alias("actual"))
    wanted = targets.select("country", "year_month", F.col("target_revenue").alias("target"))
    return actual.join(wanted, ["country", "year_month"])


def country_kpis(months: DataFrame, targets: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Yearly revenue, growth, target achievement and revenue per active customer, by country."""
    base, comparison = f"rev_{config.base_year}", f"rev_{config.comparison_year}"

    def revenue(of: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("year") == of, F.col("net_revenue"))), F.lit(0))

    per_customer = months.groupBy("country", "customer_id").agg(
        revenue(config.base_year).alias(base),
        revenue(config.comparison_year).alias(comparison),
        F.bool_or(F.col("year") == config.comparison_year).alias("active"),
    )
    per_year = per_customer.groupBy("country").agg(
        F.sum(base).alias(base),
        F.sum(comparison).alias(comparison),
        F.count_if(F.col("active") & F.col("customer_id").isNotNull()).alias("active_customers"),
    )
    achieved = (
        monthly_actual_vs_target(months, targets)
        .groupBy("country")
        .agg((_share(F.sum("actual"), F.sum("target")) * 100).alias("target_achievement_pct"))
    )
    return (
        per_year.where("country IS NOT NULL")
        .join(achieved, "country")
        .select(
            "country",
            base,
            comparison,
            (_share(F.col(comparison) - F.col(base), F.col(base)) * 100).alias("yoy_growth_pct"),
            "target_achievement_pct",
            _share(F.col(comparison), F.col("active_customers")).alias("rev_per_customer"),
        )
    )


def country_kpis_display(kpis: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    """The same table for reading: largest comparison year first, one digit."""
    ordered = kpis.orderBy(F.col(f"rev_{config.comparison_year}").desc(), "country")
    return ordered.select("country", *[F.bround(c, 1).alias(c) for c in kpis.columns if c != "country"])


def headline_numbers(months: DataFrame, analytics: DataFrame, config: RetailConfig = RetailConfig()) -> DataFrame:
    year = F.col("year")
    segments = analytics.agg(
        F.struct(
            F.count_if(F.col("segment") == "Champions").alias("champions"),
            F.count_if(F.col("segment") == "At Risk").alias("at_risk"),
        )
    ).scalar()
    c = F.col
    totals = (
        months.agg(
            F.sum(F.when(year == config.base_year, c("net_revenue"))).alias("base"),
            F.sum(F.when(year == config.comparison_year, c("net_revenue"))).alias("comparison"),
            F.coalesce(F.sum("deep_orders"), F.lit(0)).alias("deep_orders"),
            # Means of doubles: digits past the ninth depend on the order in which tasks finish.
            F.round(_share(F.sum("deep_margins"), F.sum("deep_margin_rows")), 9).alias("deep_margin"),
            F.round(_share(F.sum("full_price_margins"), F.sum("full_price_margin_rows")), 9).alias("full_price_margin"),
        )
        .withColumn("growth", _share(c("comparison"), c("base")) - 1)
        .withColumn("compression", F.round(c("full_price_margin") - c("deep_margin"), 9))
        .withColumn("segments", segments)
    )
    threshold = f"{int(Decimal(str(config.deep_discount)) * 100)}%+"
    return _report(
        totals,
        "metric",
        [
            (
                f"{config.comparison_year} YoY Revenue Growth",
                c("growth"),
                F.concat(F.lit("+"), percent(c("growth"), 0)),
            ),
            ("Champions", c("segments.champions"), whole(c("segments.champions"))),
            ("At-Risk", c("segments.at_risk"), whole(c("segments.at_risk"))),
            (f"Orders with {threshold} discount", c("deep_orders"), whole(c("deep_orders"))),
            (f"Margin at {threshold} discount", c("deep_margin"), percent(c("deep_margin"))),
            ("Margin at no discount", c("full_price_margin"), percent(c("full_price_margin"))),
            ("Margin compression", c("compression"), F.concat(percent(c("compression")), F.lit(" pp"))),
        ],
    )
