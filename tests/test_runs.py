"""Both lineages from raw tables to stored results."""

from pyspark.sql import functions as F

from ledgerloom.plans import enrichment, runs, staging
from ledgerloom.plans.staging_views import STAGING, create_staging_views
from ledgerloom.queries import QUERIES
from ledgerloom.sinks.warehouse import load_raw, model_table_name, scratch_databases
from ledgerloom.sources.star_schema import RetailTables, star_schema_config

FOLDER = "/root/testdata/sf0.001"
CONFIG = star_schema_config()


def test_model_table_name():
    assert model_table_name(" marts ", "fct_orders") == "marts.fct_orders"
    assert model_table_name(None, "x", "analytics") == "analytics.x"


def test_models_are_stored_in_their_layers_and_tested(spark):
    models, tests = runs.run_models(spark, RetailTables(spark, FOLDER).by_name(), CONFIG)
    fct, staged = spark.table("marts.fct_orders"), models["stg_orders"]
    # An order that was returned twice has two rows; the test of the order id reports it.
    assert fct.count() == staged.select("order_id").join(models["stg_returns"], "order_id", "left").count()
    assert {r.order_id for r in fct.select("order_id").collect()} == {r.order_id for r in staged.select("order_id").collect()}
    assert spark.catalog.tableExists("intermediate.int_customer_rfm")
    results = {(r.table_name, r.column_name, r.test_name): r.passed for r in tests.collect()}
    assert len(results) == 47
    assert not results["orders", "order_id", "unique"] and results["products", "product_id", "unique"]
    mart, fct = spark.table("marts.mart_commercial_kpis"), spark.table("marts.fct_orders")
    assert mart.agg(F.sum("total_units")).first() == fct.agg(F.sum("quantity")).first()
    # A second run replaces the tables.
    again, _ = runs.run_models(spark, RetailTables(spark, FOLDER).by_name(), CONFIG)
    assert spark.table("marts.fct_orders").count() == again["fct_orders"].count() == fct.count()


def test_nothing_is_left_behind(spark):
    before = {d.name for d in spark.catalog.listDatabases()}
    for name in ("post_load_counts", "source_tables", "staging_views"):
        assert QUERIES[name](spark, FOLDER).count() == 5
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_staging_views_say_what_the_functions_say(spark, tmp_path):
    tables = RetailTables(spark, FOLDER).by_name()
    with scratch_databases(spark, str(tmp_path), "raw", "layer") as [raw, layer]:
        load_raw(spark, tables, raw)
        views = create_staging_views(spark, raw, layer, CONFIG)
        assert list(views) == list(STAGING) and views["stg_orders"] == f"{layer}.stg_orders"
        for name, view in views.items():
            source = spark.table(f"{raw}.{name.removeprefix('stg_')}")
            make = getattr(staging, name)
            own, other = make(source, CONFIG) if name == "stg_orders" else make(source), spark.newSession().table(view)
            assert [(f.name, f.dataType) for f in own.schema] == [(f.name, f.dataType) for f in other.schema]
            assert sorted(map(str, own.collect())) == sorted(map(str, other.collect()))


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        models, _ = runs.run_models(spark, RetailTables(spark, FOLDER).by_name(), CONFIG, buckets=4)
        for joined in (
            enrichment.int_orders_enriched(models["stg_orders"], models["stg_products"]),
            enrichment.fct_orders(models["int_orders_enriched"], models["stg_returns"]),
        ):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert spark.table("marts.fct_orders").count() == models["fct_orders"].count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counts_come_from_the_writing_job(spark, tmp_path):
    raw = RetailTables(spark, FOLDER).by_name()
    counts = {r.table_name: (r.rows_read, r.rows_written, r.removed) for r in runs.clean_and_count(raw, str(tmp_path), CONFIG).collect()}
    for name, (read, written, removed) in counts.items():
        assert read == raw[name].count() and written == spark.read.parquet(f"{tmp_path}/{runs.CLEANED[name]}").count() == read - removed
    assert counts["orders"][2] > 0 == counts["products"][2]


def test_notebook_lineage_is_stored(spark, tmp_path):
    cleaned, curated = f"{tmp_path}/cleaned", f"{tmp_path}/curated"
    summary = runs.run_cleaning(RetailTables(spark, FOLDER).by_name(), cleaned, CONFIG).first()
    assert summary.checks == 22 and 0 < summary.passed < 22
    stored = runs.run_enrichment(spark, cleaned, curated, CONFIG)
    orders = stored["orders_enriched"]
    assert orders.count() == orders.select("order_id").distinct().count()
    assert stored["dim_date"].count() == orders.count()
    assert stored["kpis_commercial"].count() == 8
    text = spark.read.option("header", True).csv(f"{curated}/csv/customer_retention_analysis")
    assert text.count() == 7 and "value" in text.columns
