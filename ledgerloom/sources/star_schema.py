"""The five raw retail tables, derived from order tables in the TPC-H style.

Grain and dirt are kept on purpose: order ids repeat, some orders ship before they are placed, some carry
impossible quantities and discounts, and some name a product or a country that no other table knows.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.config import RetailConfig
from ledgerloom.sources.tables import TABLES, read_parquet

ORDER_COLUMNS = [
    "l_orderkey * 10 + l_linenumber AS order_id",
    "cast(o_orderdate AS date) AS order_date",
    "cast(l_shipdate AS date) AS ship_date",
    "o_custkey AS customer_id",
    "CASE WHEN l_partkey % 53 = 7 THEN -l_partkey ELSE l_partkey END AS product_id",
    "CASE WHEN o_custkey % 41 = 5 THEN 'Atlantis' ELSE n_name END AS country",
    "CASE o_orderstatus WHEN 'F' THEN 'Web' WHEN 'O' THEN 'Mobile App' ELSE 'Marketplace' END AS channel",
    "cast(l_quantity AS int) % 7 AS quantity",
    "cast(p_retailprice AS decimal(12,2)) AS unit_price",
    "cast(cast(l_discount AS decimal(4,2)) * 6 AS decimal(4,2)) AS discount",
    "cast(cast(l_tax AS decimal(4,2)) * 100 AS decimal(12,2)) AS shipping_cost",
    """CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'Credit Card' WHEN '2' THEN 'PayPal'
       WHEN '3' THEN 'Bank Transfer' WHEN '4' THEN 'Apple Pay' ELSE 'Klarna' END AS payment_method""",
]
PRODUCT_COLUMNS = [
    "p_partkey AS product_id",
    "p_name AS product_name",
    "p_type AS category",
    "concat('S', cast(p_size AS string)) AS `sub-category`",
    "p_brand AS brand",
    """cast(cast(p_retailprice AS decimal(12,2)) * cast(40 + p_size % 20 AS decimal(4,0))
       * cast(0.01 AS decimal(3,2)) AS decimal(14,4)) AS unit_cost""",
    "cast(p_retailprice AS decimal(12,2)) AS list_price",
    "date'1990-01-01' AS launch_date",
]
CUSTOMER_COLUMNS = [
    "c_custkey AS customer_id",
    "c_name AS customer_name",
    "c_mktsegment AS segment",
    "n_name AS country",
    "concat('City ', cast(c_nationkey AS string)) AS city",
    "date'1990-01-01' AS acquisition_date",
    """CASE c_custkey % 6 WHEN 0 THEN 'Paid Search' WHEN 1 THEN 'Organic Search' WHEN 2 THEN 'Direct'
       WHEN 3 THEN 'Email' WHEN 4 THEN 'Social' ELSE 'Referral' END AS acquisition_channel""",
]
RETURN_COLUMNS = [
    "l_orderkey * 10 + l_linenumber AS order_id",
    "cast(l_shipdate AS date) AS return_date",
    "CASE l_linestatus WHEN 'F' THEN 'Wrong size' ELSE 'Damaged' END AS reason",
]
TARGET_COLUMNS = [
    "country",
    "`year-month`",
    """cast(10000 + 1000 * n_nationkey + 500 * cast(split_part(`year-month`, '-', 2) AS int)
       AS decimal(12,2)) AS target_revenue""",
]


def star_schema_config() -> RetailConfig:
    """Dates and accepted values that suit these tables."""
    return replace(
        RetailConfig(),
        snapshot_date="2001-08-02",
        base_year=1999,
        comparison_year=2000,
        countries=tuple(f"NATION_{i}" for i in range(25)),
        categories=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
        segments=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    )


class RetailTables:
    """The five tables over one folder of parquet files. Each file is opened once, when it is first needed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._opened: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = read_parquet(self.spark, f"{self.folder}/{name}.parquet")
        return self._opened[name]

    @cached_property
    def orders(self) -> DataFrame:
        lines = self.read("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_shipdate"
        )
        heads = self.read("orders").selectExpr(
            "o_orderkey AS l_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
        )
        parts = self.read("part").selectExpr("p_partkey AS l_partkey", "p_retailprice")
        people = self.read("customer").selectExpr("c_custkey AS o_custkey", "c_nationkey")
        joined = lines.join(heads, "l_orderkey").join(parts, "l_partkey").join(people, "o_custkey")
        return joined.join(self._nations, "c_nationkey").selectExpr(*ORDER_COLUMNS)

    @cached_property
    def products(self) -> DataFrame:
        return self.read("part").selectExpr(*PRODUCT_COLUMNS)

    @cached_property
    def customers(self) -> DataFrame:
        people = self.read("customer").join(self._nations, "c_nationkey")
        return people.selectExpr(*CUSTOMER_COLUMNS)

    @cached_property
    def returns(self) -> DataFrame:
        return self.read("lineitem").where("l_returnflag = 'R'").selectExpr(*RETURN_COLUMNS)

    @cached_property
    def sales_targets(self) -> DataFrame:
        """One target per nation and calendar month that has orders."""
        month = F.date_format("o_orderdate", "yyyy-MM")
        months = self.read("orders").agg(F.sort_array(F.collect_set(month))).scalar()
        nations = self.read("nation")
        return nations.select(
            "n_nationkey", F.col("n_name").alias("country"), F.explode(months).alias("year-month")
        ).selectExpr(*TARGET_COLUMNS)

    @property
    def _nations(self) -> DataFrame:
        return self.read("nation").selectExpr("n_nationkey AS c_nationkey", "n_name")

    def by_name(self, *names: str) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in names or TABLES}


# Faults that the tables lack of themselves, planted by id: (column, expression) for the rows that satisfy a condition.
ORDER_FAULTS = {
    "channel": "CASE WHEN order_id % 101 = 1 THEN 'Fax' WHEN order_id % 103 = 2 THEN NULL ELSE channel END",
    "country": "CASE WHEN order_id % 107 = 5 THEN concat('Land ', cast(order_id % 8 AS string)) ELSE country END",
    "unit_price": "cast(CASE WHEN order_id % 109 = 4 THEN 0 WHEN order_id % 113 = 6 THEN unit_price * 40 ELSE unit_price END AS decimal(12,2))",
    "shipping_cost": "cast(CASE WHEN order_id % 127 = 8 THEN -1 WHEN order_id % 137 = 10 THEN 900 ELSE shipping_cost END AS decimal(12,2))",
    "customer_id": "CASE WHEN order_id % 131 = 9 THEN -customer_id ELSE customer_id END",
}
PRODUCT_FAULTS = {
    "category": "CASE WHEN product_id % 29 = 3 THEN 'Other' ELSE category END",
    "unit_cost": "cast(CASE WHEN product_id % 31 = 4 THEN list_price * 0.95 WHEN product_id % 37 = 5 THEN list_price * 1.2 ELSE unit_cost END AS decimal(14,4))",
    "list_price": "cast(CASE WHEN product_id % 41 = 6 THEN 0 ELSE list_price END AS decimal(12,2))",
    "brand": "CASE WHEN product_id % 43 = 7 THEN NULL ELSE brand END",
}
CUSTOMER_FAULTS = {
    "segment": "CASE WHEN customer_id % 53 = 3 THEN 'Private' ELSE segment END",
    "country": "CASE WHEN customer_id % 59 = 4 THEN 'Nowhere' ELSE country END",
    "city": "CASE WHEN customer_id % 61 = 5 THEN NULL ELSE city END",
}
RETURN_FAULTS = {"order_id": "CASE WHEN order_id % 71 = 5 THEN -order_id WHEN order_id % 73 = 6 THEN NULL ELSE order_id END"}


def _with_faults(df: DataFrame, faults: dict[str, str], repeated: str) -> DataFrame:
    """``df`` with its faults; rows that satisfy ``repeated`` occur three times."""
    changed = df.selectExpr(*[f"{faults[c]} AS `{c}`" if c in faults else f"`{c}`" for c in df.columns], f"CASE WHEN {repeated} THEN 3 ELSE 1 END AS _times")
    return changed.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_time")


class FaultyTables(RetailTables):
    """The same tables with planted faults, so that every check has something to find."""

    @cached_property
    def orders(self) -> DataFrame:
        return _with_faults(RetailTables.orders.func(self), ORDER_FAULTS, "order_id % 211 = 3")

    @cached_property
    def products(self) -> DataFrame:
        return _with_faults(RetailTables.products.func(self), PRODUCT_FAULTS, "product_id % 47 = 8")

    @cached_property
    def customers(self) -> DataFrame:
        return _with_faults(RetailTables.customers.func(self), CUSTOMER_FAULTS, "customer_id % 67 = 6")

    @cached_property
    def returns(self) -> DataFrame:
        return _with_faults(RetailTables.returns.func(self), RETURN_FAULTS, "order_id % 79 = 7")
