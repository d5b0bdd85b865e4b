"""Every registered query against DuckDB on the same files, and the shape of the plans."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerloom.queries import QUERIES as OWN
from tests.compare import differences, duckdb_over

FOLDER = "/root/testdata/sf0.001"
# Those of the corpus operators have tests of their own.
ORACLE = {name: sql for name, sql in oracle_sql().items() if name in OWN}
QUERIES = {name: query for name, query in queries().items() if name in OWN}


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) == []


BEYOND = [
    "fct_orders", "mart_commercial_kpis", "mart_country_targets", "mart_customer_kpis", "country_kpis", "kpis_marketing", "headline_numbers",
    "quality_report_faulty", "source_tests_faulty", "mart_tests", "orders_enriched", "int_customer_rfm", "customer_analytics",
    "describe_orders_faulty", "duplicate_rows_faulty", "clean_orders",
]


@pytest.mark.parametrize("name", BEYOND)
def test_query_equals_sql_beyond_broadcast_and_without_reuse(spark, duck, name):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.exchange.reuse": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) == []
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_rules_are_applied_before_the_first_join_and_lines_are_scanned_once(spark):
    plan = QUERIES["stg_orders"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_shipdate") and plan.count("l_linenumber#") and plan.count("Relation [l_orderkey") == 1
    deepest = max((len(line) - len(line.lstrip(" :+-")), k) for k, line in enumerate(plan.splitlines()) if "l_discount" in line and "Filter" in line)
    joins = [len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Join" in line]
    assert deepest[0] > max(joins)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["mart_commercial_kpis", "int_customer_rfm", "customer_analytics", "clean_orders", "country_kpis", "describe_orders"])
def test_no_cross_join_and_no_window_over_a_whole_table(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A window without partition columns begins with its order.
    assert not re.search(r"windowspecdefinition\(\w+#\d+L? (ASC|DESC)", plan)
    assert not re.search(r"(Python|Pandas|Arrow)", plan)


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["total_orders_by_month"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    fact_scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line and "l_quantity" in line)
    assert "l_tax" not in fact_scan and "l_extendedprice" not in fact_scan


def test_round_trip_counts_what_is_lost_and_keeps_nothing(spark, tmp_path):
    tables = {
        "nation": "SELECT 0 AS n_nationkey, '' AS n_name UNION ALL SELECT 1, 'NATION_1'",
        "customer": "SELECT id AS c_custkey, cast(id % 2 AS int) AS c_nationkey FROM range(1, 3)",
        "part": "SELECT id AS p_partkey, 10.0D AS p_retailprice FROM range(1, 3)",
        "orders": "SELECT id AS o_orderkey, id AS o_custkey, timestamp'2000-01-01' AS o_orderdate, 'F' AS o_orderstatus, '1-URGENT' AS o_orderpriority FROM range(1, 3)",
        "lineitem": """SELECT id AS l_orderkey, 1 AS l_linenumber, id AS l_partkey, 2.0D AS l_quantity, 0.01D AS l_discount, 0.0D AS l_tax,
            timestamp'2000-01-02' AS l_shipdate FROM range(1, 3) CROSS JOIN range(3) AS copies(copy)""",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    result = QUERIES["write_read_roundtrip"](spark, str(tmp_path))
    # CSV reads an empty country as NULL: three rows of each copy are not in the other.
    assert result.first().asDict() == {"parquet_differences": 0, "csv_differences": 6, "rows_written": 6}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
