"""Every result of the library as a named query over a folder of star-schema parquet files."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions import calendar, display, measures, text
from ledgerloom.operators import checks, dedup, joins, profile, ranking
from ledgerloom.plans import cleaning, enrichment, kpis, marts, quality, runs, scoring, staging
from ledgerloom.plans.staging_views import create_staging_views
from ledgerloom.sinks import files, warehouse
from ledgerloom.sources.star_schema import FaultyTables, RetailTables, star_schema_config
from ledgerloom.sources.schemas import RAW_COLUMNS
from ledgerloom.sources.tables import TABLES, corrupt_records, load_tables, read_parquet, source_table

Query = Callable[[SparkSession, str], DataFrame]
CONFIG = star_schema_config()
NUMERIC_ORDER_COLUMNS = ("unit_price", "discount", "quantity", "shipping_cost")
PROFILED = ("orders", "products", "customers", "returns")

QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that engines with other decimal rules can be compared."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in decimals}) if decimals else df


def query(make: Callable[[RetailTables], DataFrame]):
    """Register a query under its function name."""
    QUERIES[make.__name__] = lambda spark, folder: comparable(make(RetailTables(spark, folder)))
    return make


# --- lineage B: staging, facts, marts ---------------------------------------------------------------------


@query
def stg_orders(t: RetailTables) -> DataFrame:
    return staging.stg_orders(t.orders, CONFIG)


@query
def stg_products(t):
    return staging.stg_products(t.products)


@query
def stg_customers(t):
    return staging.stg_customers(t.customers)


@query
def stg_returns(t):
    return staging.stg_returns(t.returns)


@query
def stg_sales_targets(t):
    return staging.stg_sales_targets(t.sales_targets)


@query
def int_orders_enriched(t):
    return enrichment.int_orders_enriched(stg_orders(t), stg_products(t))


@query
def fct_orders(t):
    return enrichment.fct_orders(int_orders_enriched(t), stg_returns(t))


@query
def fct_orders_first_return(t):
    return enrichment.fct_orders(int_orders_enriched(t), stg_returns(t), on_duplicate_returns="first")


@query
def strip_text(t):
    """White space of many kinds around customer names goes, inside it stays."""
    blanks = F.array(*[F.lit(b) for b in ("\u00a0", "\u3000", "\t \x1f", "\u2003\u0085")])
    blank = F.element_at(blanks, (F.pmod(F.col("customer_id"), F.lit(4)) + 1).cast("int"))
    padded = F.concat(blank, F.col("customer_name"), blank, F.col("city"), blank)
    return t.customers.select("customer_id", text.strip(padded).alias("stripped"))


@query
def total_orders_by_month(t):
    return marts.total_orders_by_month(fct_orders(t))


@query
def disc_tier_sql(t):
    tiers = int_orders_enriched(t).groupBy("discount", "disc_tier")
    return tiers.agg(F.count("*").alias("orders"))


@query
def mart_commercial_kpis(t):
    return marts.mart_commercial_kpis(fct_orders(t))


@query
def mart_country_targets(t):
    return marts.mart_country_targets(fct_orders(t), stg_sales_targets(t), CONFIG)


@query
def int_customer_rfm(t):
    return scoring.int_customer_rfm(int_orders_enriched(t), CONFIG)


@query
def mart_customer_kpis(t):
    return marts.mart_customer_kpis(stg_customers(t), int_customer_rfm(t), CONFIG)


@query
def ntile_distributed(t):
    base = scoring.rfm_base(stg_orders(t), CONFIG).select("customer_id", *scoring.SCORES.values())
    return ranking.tile_by_rank(base, "customer_id", {c: F.col(c) for c in scoring.SCORES.values()})


# --- quality -----------------------------------------------------------------------------------------------


@query
def profile_nulls(t):
    return profile.profile_tables(t.by_name(*PROFILED))


@query
def columns_with_nulls(t):
    return profile.columns_with_nulls(int_orders_enriched(t))


@query
def duplicate_rows(t):
    return profile.duplicate_rows_by_table(t.by_name(*PROFILED))


@query
def describe_orders(t):
    return profile.describe(t.orders, NUMERIC_ORDER_COLUMNS)


@query
def iqr_outliers(t):
    return profile.iqr_outliers(t.orders, NUMERIC_ORDER_COLUMNS)


@query
def quality_report(t):
    return quality.quality_report(t.by_name(*PROFILED), CONFIG)


@query
def quality_report_summary(t):
    return checks.report_summary(quality_report(t))


@query
def unique_violations(t):
    return checks.duplicated_values(t.orders, "order_id")


@query
def fk_violations(t):
    orders, products = t.orders, t.products
    return joins.orphan_keys(orders, "product_id", products, "product_id")


@query
def accepted_values(t):
    """Against the lists of the original data set, so that values outside of them are found."""
    return quality.unaccepted_source_values(t.by_name("orders", "products", "customers"))


@query
def source_tests(t):
    return checks.run_column_tests(t.by_name(), quality.source_tests(CONFIG))


@query
def mart_tests(t):
    models = {"fct_orders": fct_orders(t), "mart_customer_kpis": mart_customer_kpis(t)}
    return checks.run_column_tests(models, quality.mart_tests())


def faulty(t: RetailTables) -> FaultyTables:
    return FaultyTables(t.spark, t.folder)


@query
def quality_report_faulty(t):
    """Over tables with planted faults: every check finds some."""
    return quality.quality_report(faulty(t).by_name(*PROFILED), CONFIG)


@query
def source_tests_faulty(t):
    return checks.run_column_tests(faulty(t).by_name(), quality.source_tests(CONFIG))


@query
def profile_nulls_faulty(t):
    return profile.profile_tables(faulty(t).by_name(*PROFILED))


@query
def duplicate_rows_faulty(t):
    return profile.duplicate_rows_by_table(faulty(t).by_name(*PROFILED))


@query
def describe_orders_faulty(t):
    return profile.describe(faulty(t).orders, NUMERIC_ORDER_COLUMNS)


@query
def iqr_outliers_faulty(t):
    return profile.iqr_outliers(faulty(t).orders, NUMERIC_ORDER_COLUMNS)


@query
def table_shapes(t):
    return profile.table_shapes(t.by_name())


@query
def preview_orders(t):
    orders = t.orders
    return profile.preview(orders, orders.columns)


# --- lineage A: cleaning -----------------------------------------------------------------------------------


@query
def clean_orders(t):
    return cleaning.clean_orders(t.orders, CONFIG)


@query
def clean_products(t):
    return cleaning.clean_products(t.products)


@query
def clean_customers(t):
    return cleaning.clean_customers(t.customers, CONFIG)


@query
def clean_returns(t):
    return cleaning.clean_returns(t.returns)


@query
def clean_targets(t):
    return cleaning.clean_targets(t.sales_targets)


@query
def dedup_first(t):
    return dedup.keep_first(t.returns, ["order_id"])


@query
def dedup_removed_count(t):
    removed = {n: dedup.removed_count(df, ["order_id"]) for n, df in t.by_name("orders", "returns").items()}
    return profile.union_all([df.select(F.lit(n).alias("table_name"), "removed") for n, df in removed.items()])


@query
def parse_date_tolerant(t):
    """Order dates as text are dates; order priorities are not and give NULL."""
    heads = t.read("orders")
    return heads.select(
        F.col("o_orderkey").alias("order_key"),
        calendar.parse_date_or_null(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("parsed_date"),
        calendar.parse_date_or_null(F.col("o_orderpriority")).alias("parsed_priority"),
    )


# --- lineage A: enrichment, scores, reports ----------------------------------------------------------------


@query
def orders_enriched(t):
    return enrichment.orders_enriched(clean_orders(t), clean_products(t))


@query
def date_dimensions(t):
    return enrichment.dim_date(orders_enriched(t))


@query
def rfm_qcut(t):
    base = scoring.rfm_base(orders_enriched(t), CONFIG).select("customer_id", *scoring.SCORES.values())
    return ranking.bins_by_quantile(base, {c: F.col(c) for c in scoring.SCORES.values()})


@query
def customer_analytics(t):
    return scoring.customer_analytics(orders_enriched(t), CONFIG)


@query
def customer_profit(t):
    return scoring.customer_profit(orders_enriched(t))


@query
def score_distribution(t):
    return scoring.score_distribution(customer_analytics(t))


@query
def segment_distribution(t):
    return scoring.segment_distribution(customer_analytics(t))


def customer_months(t):
    return kpis.customer_months(orders_enriched(t), CONFIG)


def stored_customer_months(t):
    return kpis.stored_customer_months(orders_enriched(t), CONFIG)


@query
def retention(t):
    return kpis.retention(customer_months(t), CONFIG)


@query
def retained_customers(t):
    return kpis.retained_customers(customer_months(t), CONFIG)


@query
def new_customers(t):
    return kpis.new_customers(customer_months(t), CONFIG)


@query
def order_totals(t):
    return kpis.order_totals(orders_enriched(t))


@query
def kpis_commercial(t):
    return kpis.kpis_commercial(orders_enriched(t), clean_returns(t))


@query
def kpis_marketing(t):
    months = stored_customer_months(t)
    return kpis.kpis_marketing(months, scoring.analytics_of_months(months, CONFIG), CONFIG)


@query
def disc_impact(t):
    return kpis.disc_impact(orders_enriched(t))


@query
def monthly_actual_vs_target(t):
    return kpis.monthly_actual_vs_target(customer_months(t), clean_targets(t))


@query
def country_kpis(t):
    return kpis.country_kpis(stored_customer_months(t), clean_targets(t), CONFIG)


@query
def country_kpis_display(t):
    return kpis.country_kpis_display(country_kpis(t), CONFIG)


@query
def headline_numbers(t):
    months = stored_customer_months(t)
    return kpis.headline_numbers(months, scoring.analytics_of_months(months, CONFIG), CONFIG)


# --- single functions over whole columns -------------------------------------------------------------------


@query
def title_case(t):
    people = t.customers
    label = F.concat_ws("-", "segment", "acquisition_channel", "customer_name")
    return people.select("customer_id", text.title_case(label).alias("label"))


@query
def alias_country(t):
    """Nations 0, 3, 6 … under an alias or with blanks, then normalised as the cleaners do."""
    names = list(CONFIG.country_aliases)
    dirty = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("customer_id") % len(names) + 1).cast("int"))
    people = t.customers.select(
        "customer_id",
        F.when(F.col("customer_id") % 3 == 0, dirty)
        .when(F.col("customer_id") % 3 == 1, F.concat(F.lit(" "), dirty, F.lit(" ")))
        .otherwise(F.col("country"))
        .alias("country_raw"),
    )
    replaced = text.replace_exact(F.col("country_raw"), CONFIG.country_aliases)
    return people.withColumn("country", text.title_case(text.strip(replaced)))


@query
def clip_discount(t):
    orders = t.orders
    clipped = measures.clip(F.col("discount"), "0", CONFIG.max_discount)
    return orders.groupBy("discount").agg(F.first(clipped).alias("clipped"), F.count("*").alias("orders"))


@query
def fiscal_calendar(t):
    dates = t.orders.select("order_date").distinct()
    d = F.col("order_date")
    return dates.select(
        "order_date",
        calendar.fiscal_year(d).alias("fiscal_year"),
        calendar.fiscal_quarter(d).alias("fiscal_quarter"),
    )


@query
def display_formats(t):
    parts = t.read("part")
    price = F.col("p_retailprice")
    return parts.select(
        F.col("p_partkey").alias("product_id"),
        display.euros(price).alias("whole_euros"),
        display.euros(price * F.col("p_size"), 2).alias("euros"),
        display.percent(price / 10000).alias("share"),
        display.signed_percent(price / 7).alias("growth"),
        display.whole(F.col("p_partkey")).alias("rank_text"),
    )


@query
def snake_case_columns(t):
    products = t.products
    headers = [c.replace("_", " ").title() + " " for c in products.columns]
    return text.with_snake_case_columns(products.toDF(*headers)).withColumnRenamed("sub-category", "sub_category")


# --- sinks -------------------------------------------------------------------------------------------------


def _scratch(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder, or in a temporary one for a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{shared.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"


@query
def write_read_roundtrip(t):
    """Rows that differ after a round trip through parquet and CSV, with the number of rows written.

    The orders are joined once and kept on disk for both writes and the comparison.
    """
    original = stg_orders(t).persist(StorageLevel.DISK_ONLY)
    try:
        path = _scratch(t.spark)
        files.write_parquet(original, f"{path}/parquet")
        files.write_csv(original, f"{path}/csv")
        stored = read_parquet(t.spark, f"{path}/parquet")
        text_file = t.spark.read.schema(stored.schema).option("header", True).csv(f"{path}/csv")
        counts = profile.differing_rows(
            {"original": original, "stored": stored, "text": text_file},
            {"parquet_differences": ("original", "stored"), "csv_differences": ("stored", "text")},
        ).withColumn("rows_written", stored.agg(F.count("*")).scalar())
        return t.spark.createDataFrame(counts.collect(), counts.schema)
    finally:
        original.unpersist()


@query
def post_load_counts(t):
    """Load the raw tables into a database, which goes again; each row count comes from the job that writes."""
    with warehouse.scratch_databases(t.spark, _scratch(t.spark), "raw") as [raw]:
        return warehouse.load_raw(t.spark, t.by_name(), raw)


@query
def source_tables(t):
    """The declared sources, read from the catalog: rows, columns, and rows without a first column."""
    with warehouse.scratch_databases(t.spark, _scratch(t.spark), "raw") as [raw]:
        warehouse.load_raw(t.spark, t.by_name(), raw)
        sources = {name: source_table(t.spark, name, raw) for name in TABLES}
        counted = [
            df.agg(F.count("*").alias("row_count"), F.count_if(F.col(df.columns[0]).isNull()).alias("unnamed")).select(
                F.lit(name).alias("table_name"), "row_count", "unnamed", F.lit(", ".join(df.columns)).alias("columns")
            )
            for name, df in sources.items()
        ]
        rows = profile.union_all(counted)
        return t.spark.createDataFrame(rows.collect(), rows.schema)


@query
def staging_views(t):
    """The staging models as views of their layer, read in another session: rows, columns and the sum of a measure."""
    measures_of = {"stg_orders": "net_revenue", "stg_products": "product_margin_pct", "stg_sales_targets": "target_revenue"}
    with warehouse.scratch_databases(t.spark, _scratch(t.spark), "raw", "staging") as [raw, layer]:
        warehouse.load_raw(t.spark, t.by_name(), raw)
        views = create_staging_views(t.spark, raw, layer, CONFIG)
        elsewhere = t.spark.newSession()
        rows = []
        for model, view in views.items():
            df = elsewhere.table(view)
            total = F.sum(F.col(measures_of[model]).cast("double")) if model in measures_of else F.lit(None).cast("double")
            row = df.agg(F.count("*").alias("n"), F.round(total, 2).alias("total")).first()
            kind = elsewhere.catalog.getTable(view)
            rows.append((model, kind.tableType, kind.isTemporary, row.n, len(df.columns), row.total))
        return t.spark.createDataFrame(rows, "model string, kind string, temporary boolean, row_count long, column_count int, total double")


@query
def csv_corrupt_dates(t):
    """CSV files with planted bad dates, read with declared types: how many records a raising reader would stop at."""
    bad_orders = F.when(F.col("order_id") % 97 == 3, "2024-13-45").when(F.col("order_id") % 89 == 4, "not a date")
    bad_returns = F.when(F.col("order_id") % 83 == 5, "31/12/2024")
    tables = t.by_name()
    tables["orders"] = tables["orders"].withColumn("order_date", F.coalesce(bad_orders, F.col("order_date").cast("string")))
    tables["returns"] = tables["returns"].withColumn("return_date", F.coalesce(bad_returns, F.col("return_date").cast("string")))
    folder = _scratch(t.spark)
    for name, df in tables.items():
        files.write_csv(df.toDF(*[header for header, _ in RAW_COLUMNS[name]]), f"{folder}/{name}")
    return corrupt_records(load_tables(t.spark, folder, "csv", dates="keep"))


@query
def cleaning_row_counts(t):
    """Rows read, written and removed by each cleaner, counted by the job that writes."""
    return runs.clean_and_count(t.by_name(), _scratch(t.spark), CONFIG)
