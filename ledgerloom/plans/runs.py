"""Whole runs: each lineage from raw tables to stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.config import RetailConfig
from ledgerloom.operators.checks import report_summary, run_column_tests
from ledgerloom.plans import cleaning, enrichment, kpis, marts, quality, scoring
from ledgerloom.sinks.files import write_csv, write_parquet
from ledgerloom.plans.staging_views import STAGING, create_staging_views
from ledgerloom.sinks.warehouse import counted, create_databases, load_raw, model_table_name, write_table
from ledgerloom.sources.tables import read_parquet, source_table

LAYER_OF = {
    **dict.fromkeys(STAGING, "staging"),
    "int_orders_enriched": "intermediate",
    "int_customer_rfm": "intermediate",
    "fct_orders": "marts",
    "mart_commercial_kpis": "marts",
    "mart_customer_kpis": "marts",
    "mart_country_targets": "marts",
}


def clean_and_count(tables: dict[str, DataFrame], folder: str, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Clean and store the five tables. Gives table, rows read, rows written and rows removed, from the same jobs."""
    cleaners = {
        "orders": lambda df: cleaning.clean_orders(df, config),
        "products": cleaning.clean_products,
        "customers": lambda df: cleaning.clean_customers(df, config),
        "returns": cleaning.clean_returns,
        "sales_targets": cleaning.clean_targets,
    }
    rows = []
    for name, clean in cleaners.items():
        raw, read = counted(tables[name], f"read {name}")
        cleaned, written = counted(clean(raw), f"clean {name}")
        write_parquet(cleaned, f"{folder}/{CLEANED[name]}")
        rows_read, rows_written = read.get["rows"], written.get["rows"]
        rows.append((name, rows_read, rows_written, rows_read - rows_written))
    spark = tables["orders"].sparkSession
    return spark.createDataFrame(rows, "table_name string, rows_read long, rows_written long, removed long")


CLEANED = {
    "orders": "orders_clean",
    "products": "products_clean",
    "customers": "customers_clean",
    "returns": "returns_clean",
    "sales_targets": "targets_clean",
}


def run_cleaning(tables: dict[str, DataFrame], folder: str, config: RetailConfig = RetailConfig()) -> DataFrame:
    """Lineage A, first part: check, clean and store the five tables. Returns the pass count of the checks."""
    write_parquet(quality.quality_report(tables, config), f"{folder}/quality_report")
    write_parquet(clean_and_count(tables, folder, config), f"{folder}/row_counts")
    spark = tables["orders"].sparkSession
    return report_summary(read_parquet(spark, f"{folder}/quality_report"))


def run_enrichment(
    spark: SparkSession, cleaned: str, curated: str, config: RetailConfig = RetailConfig()
) -> dict[str, DataFrame]:
    """Lineage A, second part: from the cleaned files to the curated ones. Returns the stored tables."""
    orders, products, returns, targets = (
        read_parquet(spark, f"{cleaned}/{name}_clean") for name in ("orders", "products", "returns", "targets")
    )
    write_parquet(enrichment.orders_enriched(orders, products), f"{curated}/orders_enriched")
    enriched = read_parquet(spark, f"{curated}/orders_enriched")
    write_csv(enriched, f"{curated}/csv/orders_enriched")
    write_parquet(enrichment.dim_date(enriched), f"{curated}/dim_date")
    write_parquet(scoring.customer_analytics(enriched, config), f"{curated}/customer_analytics")
    analytics = read_parquet(spark, f"{curated}/customer_analytics")
    write_csv(analytics, f"{curated}/csv/customer_analytics")
    write_parquet(kpis.customer_months(enriched, config), f"{curated}/customer_months")
    months = read_parquet(spark, f"{curated}/customer_months")
    reports = {
        "customer_retention_analysis": kpis.retention(months, config),
        "kpis_commercial": kpis.kpis_commercial(enriched, returns),
        "kpis_marketing": kpis.kpis_marketing(months, analytics, config),
        "country_kpis": kpis.country_kpis(months, targets, config),
    }
    for name, report in reports.items():
        write_parquet(report, f"{curated}/{name}")
        write_csv(read_parquet(spark, f"{curated}/{name}"), f"{curated}/csv/{name}", single_file=True)
    stored = ("orders_enriched", "dim_date", "customer_analytics", "customer_months", *reports)
    return {name: read_parquet(spark, f"{curated}/{name}") for name in stored}


def run_models(
    spark: SparkSession, raw: dict[str, DataFrame], config: RetailConfig = RetailConfig(), buckets: int = 0
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Lineage B: load the raw tables, build staging as views and the rest as tables, in dependency order.

    Returns the models by name, and the results of the declared tests. The fact tables are partitioned by year:
    a partition per month and task would make too many small files. With ``buckets``, the tables that are joined on a
    key are stored in so many buckets of it, and the joins of orders with products and returns need no shuffle.
    """
    load_raw(spark, raw, buckets=buckets)
    create_databases(spark)
    models = {model: spark.table(name) for model, name in create_staging_views(spark, config=config).items()}

    def store(name: str, df: DataFrame, *partition_by: str, bucket_by: str | None = None) -> None:
        table = model_table_name(LAYER_OF[name], name)
        write_table(df, table, partition_by, (buckets, bucket_by) if buckets and bucket_by else None)
        models[name] = spark.table(table)

    enriched = enrichment.int_orders_enriched(models["stg_orders"], models["stg_products"])
    store("int_orders_enriched", enriched, "year", bucket_by="order_id")
    store("int_customer_rfm", scoring.int_customer_rfm(models["int_orders_enriched"], config))
    store("fct_orders", enrichment.fct_orders(models["int_orders_enriched"], models["stg_returns"]), "year")
    store("mart_commercial_kpis", marts.mart_commercial_kpis(models["fct_orders"]))
    store("mart_customer_kpis", marts.mart_customer_kpis(models["stg_customers"], models["int_customer_rfm"], config))
    store("mart_country_targets", marts.mart_country_targets(models["fct_orders"], models["stg_sales_targets"], config))
    tests = run_column_tests({t: source_table(spark, t) for t in raw}, quality.source_tests(config))
    tests = tests.unionByName(run_column_tests(models, quality.mart_tests()))
    return models, tests
