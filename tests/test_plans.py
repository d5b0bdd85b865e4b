import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import RetailConfig
from ledgerloom.plans import cleaning, enrichment, kpis, marts, quality, scoring, staging
from ledgerloom.sources.schemas import RAW_COLUMNS
from ledgerloom.sources.tables import corrupt_records, load_tables

CONFIG = RetailConfig()
D = datetime.date
ORDER_TYPES = """order_id string, order_date date, ship_date date, customer_id string, product_id string, country string,
    channel string, quantity int, unit_price decimal(12,2), discount decimal(6,4), shipping_cost decimal(12,2),
    payment_method string"""


def order(order_id, day, customer="c1", product="p1", country="France", quantity=1, price="100", discount="0", ship=None):
    dec = lambda x: None if x is None else Decimal(x)
    return (
        order_id, day, ship or day, customer, product, country, "Web", quantity, dec(price), dec(discount),
        Decimal("1"), "Klarna",
    )


def orders_frame(spark, rows):
    return spark.createDataFrame(rows, ORDER_TYPES)


def products_frame(spark, rows=(("p1", "40", "100"), ("p2", None, "100"), ("p3", "1", "0"))):
    full = [(i, i, "home & living ", "S", " b ", c and Decimal(c), Decimal(p), "2020-01-01") for i, c, p in rows]
    return spark.createDataFrame(
        full,
        """product_id string, product_name string, category string, `sub-category` string, brand string,
           unit_cost decimal(14,4), list_price decimal(12,2), launch_date string""",
    )


def returns_frame(spark, rows):
    return spark.createDataFrame(rows, "order_id string, return_date date, reason string")


def targets_frame(spark, rows):
    return spark.createDataFrame([(c, m, Decimal(t)) for c, m, t in rows], "country string, `year-month` string, target_revenue decimal(12,2)")


def test_invalid_orders_are_dropped_by_lineage_b(spark):
    day = D(2024, 5, 1)
    rows = [
        order("ok", day, discount="0.5", quantity=5),
        order("discount", day, discount="0.51"),
        order("negative", day, discount="-0.01"),
        order("no discount", day, discount=None),
        order("price", day, price="0"),
        order("quantity", day, quantity=6),
        order("early", day, ship=D(2024, 4, 30)),
    ]
    staged = staging.stg_orders(orders_frame(spark, rows)).collect()
    assert [r.order_id for r in staged] == ["ok"]
    assert (staged[0].gross_revenue, staged[0].net_revenue, staged[0].shipping_days) == (500, 250, 0)


def test_integer_cast_rounds(spark):
    df = spark.createDataFrame([(2.6,), (2.5,), (-2.5,), (2.4,)], "q double")
    assert [r.q for r in df.select(staging.to_int(df, "q").alias("q")).collect()] == [3, 3, -3, 2]


def test_staged_product_margin(spark):
    rows = {r.product_id: r.product_margin_pct for r in staging.stg_products(products_frame(spark)).collect()}
    assert rows == {"p1": Decimal("0.6"), "p2": None, "p3": None}


def enriched_b(spark, rows):
    return enrichment.int_orders_enriched(
        staging.stg_orders(orders_frame(spark, rows)), staging.stg_products(products_frame(spark))
    )


def test_enriched_measures(spark):
    rows = [
        order("a", D(2024, 12, 30), quantity=2, discount="0.25"),
        order("b", D(2024, 7, 1), product="p2"),
        order("c", D(2024, 1, 1), product="missing"),
    ]
    got = {r.order_id: r for r in enriched_b(spark, rows).collect()}
    a = got["a"]
    assert (a.gross_revenue, a.discount_amount, a.net_revenue, a.cogs, a.gross_profit) == (200, 50, 150, 80, 70)
    assert a.margin_pct == Decimal("0.4667")
    assert (a.year, a.quarter, a.month, a.week, a.year_month, a.year_quarter) == (2024, 4, 12, 1, "2024-12", "2024-Q4")
    assert (a.fiscal_year, a.fiscal_quarter, a.month_name, a.disc_tier) == (2025, 2, "December ", "21-30%")
    for unknown in ("b", "c"):
        assert got[unknown].gross_profit is None and got[unknown].margin_pct is None
    assert got["c"].category is None and got["c"].net_revenue == 100


def test_returns_keep_the_grain_or_fan_out(spark):
    enriched = enriched_b(spark, [order("a", D(2024, 5, 1)), order("b", D(2024, 5, 2))])
    returns = staging.stg_returns(
        returns_frame(spark, [("a", D(2024, 6, 2), "late"), ("a", D(2024, 6, 1), "early"), ("x", D(2024, 6, 1), "?")])
    )
    kept = enrichment.fct_orders(enriched, returns, on_duplicate_returns="first").collect()
    assert {(r.order_id, r.is_return, r.return_reason) for r in kept} == {("a", 1, "early"), ("b", 0, None)}
    every = enrichment.fct_orders(enriched, returns)
    assert sorted((r.order_id, r.return_reason or "") for r in every.collect()) == [("a", "early"), ("a", "late"), ("b", "")]


def some_orders():
    rows = []
    for i in range(240):
        day = D(2024 + i % 2, i % 12 + 1, i % 28 + 1)
        rows.append(
            order(f"o{i % 230}", day, customer=f"c{i % 17}", product=f"p{i % 4}", country=("Spain", "Italy")[i % 3 == 0],
                  quantity=i % 6, price=str(10 + i), discount=f"0.{i % 6}", ship=D(2026, 1, 1))
        )
    return rows


def test_mart_adds_up_to_the_fact(spark):
    fct = enrichment.fct_orders(
        enriched_b(spark, some_orders()),
        staging.stg_returns(returns_frame(spark, [(f"o{i}", D(2025, 12, 1), "r") for i in range(0, 200, 7)])),
    ).cache()
    mart = marts.mart_commercial_kpis(fct)
    totals = fct.agg(F.sum("quantity"), F.sum("is_return"), F.round(F.sum("net_revenue"), 2)).first()
    assert tuple(mart.agg(F.sum("total_units"), F.sum("total_returns"), F.sum("net_revenue")).first()) == tuple(totals)
    calendar = fct.select("year", "month", "quarter", "year_month", "year_quarter", "fiscal_year", "fiscal_quarter")
    derived = mart.select(calendar.columns).distinct()
    assert set(derived.collect()) == set(calendar.distinct().collect())
    assert "Expand" not in mart._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_in_steps(spark):
    rows = [("g", "o1", "c1", 1), ("g", "o1", "c2", 2), ("g", "o1", "c2", 3), ("g", None, "c1", 4), ("g", "o2", None, 5), ("h", "o1", "c1", 6), (None, None, None, 7)]
    df = spark.createDataFrame(rows, "k string, order_id string, customer_id string, v int")
    got = marts.sums_and_counts(df, ["k"], {"v": "total"})
    want = df.groupBy("k").agg(F.count_distinct("order_id").alias("orders"), F.count_distinct("customer_id").alias("customers"), F.sum("v").alias("total"), F.count("*").alias("rows"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 3
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_distinct_counts_hold_the_rows_of_an_order_once(spark):
    rows = [("g", "o1", "c1", Decimal("0.1")), ("g", "o1", "c2", Decimal("0.2")), ("g", None, None, None)]
    got = marts.sums_and_counts(spark.createDataFrame(rows, "k string, order_id string, customer_id string, v decimal(6,4)"), ["k"], {"v": "total"})
    stages = got._jdf.queryExecution().sparkPlan().toString()
    below = stages[stages.index("Window ["):]
    assert "Aggregate" not in below
    assert dict(got.dtypes)["total"] == "decimal(36,4)"
    assert [tuple(r) for r in got.select("k", "orders", "customers", "total", "rows").collect()] == [("g", 1, 2, Decimal("0.3"), 3)]


def test_country_targets_keep_misnamed_columns(spark):
    rows = [
        order("a", D(2024, 1, 1), price="100"), order("b", D(2024, 2, 1), price="300"), order("c", D(2025, 1, 1), price="600"),
        order("d", D(2025, 1, 1), country="Spain"),
    ]
    fct = enrichment.fct_orders(enriched_b(spark, rows), staging.stg_returns(returns_frame(spark, [])))
    targets = staging.stg_sales_targets(targets_frame(spark, [("France", "2024-01", "150")]))
    got = {(r.country, r.year_month): r for r in marts.mart_country_targets(fct, targets).collect()}
    jan = got["France", "2024-01"]
    assert jan.target_achievement_pct == -50
    assert (jan.rev_2024, jan.rev_2025, jan.yoy_growth_pct) == (300, 600, 100)
    assert got["France", "2024-02"].target_revenue is None and got["France", "2024-02"].target_achievement_pct is None
    spain = got["Spain", "2025-01"]
    assert spain.rev_2024 is None and spain.yoy_growth_pct is None


def test_cleaning_repairs_and_keeps(spark):
    raw = orders_frame(
        spark,
        [
            order("a", D(2024, 5, 2), country=" españa", discount="0.7", quantity=9),
            order("a", D(2024, 5, 1), country="España", discount="-0.2", ship=D(2024, 5, 4)),
            order("b", D(2024, 5, 3), country="Deutschland", discount=None),
        ],
    )
    got = {r.order_id: r for r in cleaning.clean_orders(raw).collect()}
    assert (got["a"].country, got["a"].discount, got["a"].shipping_days) == ("Spain", 0, 3)
    assert (got["b"].country, got["b"].discount) == ("Germany", None)
    product = {r.product_id: r for r in cleaning.clean_products(products_frame(spark)).collect()}
    assert (product["p1"].category, product["p1"].brand, product["p1"].product_margin_pct) == ("Home & Living", "b", 0.6)
    assert product["p3"].product_margin_pct is None
    target = cleaning.clean_targets(targets_frame(spark, [(" FR ", "2024-07", "1")])).first()
    assert (target.country, target.year, target.month) == ("Fr", 2024, 7)


def enriched_a(spark, rows):
    return enrichment.orders_enriched(
        cleaning.clean_orders(orders_frame(spark, rows)), cleaning.clean_products(products_frame(spark))
    )


def test_retention(spark):
    rows = [
        order("1", D(2024, 1, 1), customer="left"), order("2", D(2025, 1, 1), customer="new"),
        order("3", D(2024, 1, 1), customer="stays"), order("4", D(2025, 1, 1), customer="stays"),
    ]
    months = kpis.customer_months(enriched_a(spark, rows))
    figures = kpis.retention_figures(months).first()
    assert (figures.base_customers, figures.comparison_customers, figures.retained, figures.new_customers) == (2, 2, 1, 1)
    assert figures.churn_rate == 1 - figures.retention_rate == 0.5
    assert figures.repeat_rate == pytest.approx(1 / 3)
    texts = {r.metric: r.value for r in kpis.retention(months).collect()}
    assert texts["Retained (2024 → 2025)"] == "1" and texts["Customer Growth %"] == "+0.0%"
    assert [r.customer_id for r in kpis.new_customers(months).collect()] == ["new"]
    assert [r.customer_id for r in kpis.retained_customers(months).collect()] == ["stays"]


def test_reports_come_from_one_state(spark, tmp_path):
    enriched_a(spark, [order(f"{c}-{i}", D(2024 + c % 2, c % 12 + 1, i % 27 + 1), customer=f"c{c:02}", price=str(50 + c), discount=f"0.{c % 5}") for c in range(40) for i in range(c % 7 + 1)]).write.parquet(f"{tmp_path}/e")
    enriched = spark.read.parquet(f"{tmp_path}/e")
    group = "state"
    spark.sparkContext.setJobGroup(group, "")
    try:
        months = kpis.stored_customer_months(enriched)
        reading = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        analytics = scoring.analytics_of_months(months)
        targets = cleaning.clean_targets(targets_frame(spark, [("France", "2024-01", "200")]))
        reports = [kpis.kpis_marketing(months, analytics), kpis.country_kpis(months, targets), kpis.headline_numbers(months, analytics), kpis.retention(months)]
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == reading <= 4
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    for report in reports:
        assert "FileScan" not in report._jdf.queryExecution().executedPlan().toString() and report.count() > 0
    want = scoring.customer_analytics(enriched)
    assert sorted(map(str, analytics.collect())) == sorted(map(str, want.select(analytics.columns).collect()))


def test_country_kpis_drop_months_without_target(spark):
    rows = [
        order("1", D(2024, 1, 1), price="100"), order("2", D(2024, 2, 1), price="900"),
        order("3", D(2025, 1, 1), price="500"), order("4", D(2025, 1, 1), country="Spain", customer="c2"),
    ]
    targets = cleaning.clean_targets(
        targets_frame(spark, [("France", "2024-01", "200"), ("France", "2025-01", "400"), ("Spain", "2025-01", "50")])
    )
    got = {r.country: r for r in kpis.country_kpis(kpis.customer_months(enriched_a(spark, rows)), targets).collect()}
    assert (got["France"].rev_2024, got["France"].rev_2025, got["France"].yoy_growth_pct) == (1000, 500, -50)
    assert got["France"].target_achievement_pct == 100 and got["France"].rev_per_customer == 500
    assert (got["Spain"].rev_2024, got["Spain"].yoy_growth_pct, got["Spain"].target_achievement_pct) == (0, None, 200)


def test_scores_of_both_lineages(spark):
    rows = [
        order(f"{c}-{i}", D(2024 + c % 2, c % 12 + 1, 1), customer=f"c{c:02}", price=str(50 + c))
        for c in range(30)
        for i in range(c % 10 + 1)
    ]
    by_value = scoring.customer_analytics(enriched_a(spark, rows)).toPandas()
    by_rank = scoring.int_customer_rfm(enriched_b(spark, rows)).toPandas()
    for scored in (by_value, by_rank):
        assert scored[["r", "f", "m"]].isin([1, 2, 3, 4, 5]).all().all()
        assert scored.rfm_score.between(3, 15).all()
        assert (scored.clv_estimate.astype(float) == scored.revenue.astype(float) * 1.5).all()
    assert by_value.groupby("frequency").f.nunique().max() == 1
    assert by_rank.f.value_counts().tolist() == [6] * 5
    assert by_rank.sort_values("recency").r.iloc[0] == 5


def test_quality_report_has_22_checks(spark):
    day = D(2024, 5, 1)
    tables = {
        "orders": orders_frame(spark, [order("a", day), order("a", day, country="Nowhere", quantity=7, customer="?")]),
        "products": products_frame(spark),
        "customers": spark.createDataFrame(
            [("c1", "n", "Consumer", "France", "Paris", day, "Email")],
            """customer_id string, customer_name string, segment string, country string, city string,
               acquisition_date date, acquisition_channel string""",
        ),
        "returns": returns_frame(spark, [("a", day, "r"), ("z", day, "r")]),
    }
    report = {(r.table_name, r.check_name): (r.passed, r.violations, r.detail) for r in quality.quality_report(tables).collect()}
    assert len(report) == 22
    assert report["Orders", "No duplicate Order IDs"] == (False, 1, "")
    assert report["Orders", "Valid countries"] == (False, 1, "invalid values: Nowhere")
    assert report["Orders", "Quantity in [1,5]"] == (False, 1, "")
    assert report["Products", "No null values"] == (False, 1, "")
    assert report["Products", "Margin > 10%"] == (False, 2, "low-margin: 0")
    assert report["Products", "Valid categories"] == (False, 3, "")
    assert report["Returns", "Order IDs exist"] == (False, 1, "")
    assert report["Referential", "Order → Customer FK"] == (False, 1, "")
    assert report["Customers", "Valid segments"] == (True, 0, "")


def test_declared_test_counts():
    tests = quality.source_tests()
    assert len(tests) == 38
    assert [sum(t.kind == k for t in tests) for k in ("unique", "not_null", "accepted_values", "relationships")] == [4, 25, 6, 3]
    assert len(quality.mart_tests()) == 9


def test_csv_source_has_declared_types_and_snake_case_names(spark, tmp_path):
    headers = {
        "orders": "Order ID,Order Date,Ship Date,Customer ID,Product ID,Country,Channel,Quantity,Unit Price,Discount,Shipping Cost,Payment Method\n"
        "1,2024-05-01,2024-05-03,c1,p1,FR,Web,2,10.50,0.1,0,Klarna\n",
        "products": "Product ID,Product Name,Category,Sub-Category,Brand,Unit Cost,List Price,Launch Date\np1,n,Beauty,s,b,4,10.5,2020-01-01\n",
        "customers": "Customer ID,Customer Name,Segment,Country,City,Acquisition Date,Acquisition Channel\nc1,n,Consumer,France,Paris,2020-01-01,Email\n",
        "returns": "Order ID,Return Date,Reason\n1,2024-06-01,late\n",
        "sales_targets": "Country,Year-Month,Target Revenue\nFrance,2024-05,100\n",
    }
    for name, content in headers.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text(content)
    tables = load_tables(spark, str(tmp_path))
    assert "sub-category" in tables["products"].columns and "year-month" in tables["sales_targets"].columns
    staged = staging.stg_orders(tables["orders"]).first()
    assert (staged.net_revenue, staged.shipping_days, staged.quantity) == (Decimal("18.9"), 2, 2)
    assert cleaning.clean_orders(tables["orders"]).first().country == "France"


def test_text_reader_raises_or_keeps_bad_records(spark, tmp_path):
    rows = {
        "orders": ["1,2024-05-01,2024-05-03,c1,p1,FR,Web,2,10.50,0.1,0,Klarna", "2,2024-13-45,2024-05-03,c1,p1,FR,Web,2,10.50,0.1,0,Klarna", "3,2024-05-01,soon,c1,p1,FR,Web,two,10.50,0.1,0,Klarna", "4,,,,,,,,,,,"],
        "products": ["p1,n,Beauty,s,b,4,10.5,2020-01-01"],
        "customers": ["c1,n,Consumer,France,Paris,never,Email"],
        "returns": ["1,2024-06-01,late"],
        "sales_targets": ["France,2024-05,100"],
    }
    for name, lines in rows.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text("\n".join([",".join(h for h, _ in RAW_COLUMNS[name]), *lines]) + "\n")
    kept = load_tables(spark, str(tmp_path), dates="keep")
    assert {r.table_name: (r.records, r.corrupt) for r in corrupt_records(kept).collect()} == {
        "orders": (4, 2), "products": (1, 0), "customers": (1, 1), "returns": (1, 0), "sales_targets": (1, 0),
    }
    by_id = {r.order_id: r for r in kept["orders"].collect()}
    assert by_id["1"].order_date == D(2024, 5, 1) and by_id["1"]._corrupt_record is None
    assert by_id["2"].order_date is None and by_id["2"]._corrupt_record == rows["orders"][1]
    raising = load_tables(spark, str(tmp_path), dates="raise")
    assert raising["returns"].first().return_date == D(2024, 6, 1)
    for table in ("orders", "customers"):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            raising[table].collect()
    with pytest.raises(ValueError, match="treatment of dates"):
        load_tables(spark, str(tmp_path), dates="ignore")


def test_staging_rules_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    orders_frame(spark, [order("a", D(2024, 5, 1)), order("b", D(2024, 5, 1), discount="0.9")]).write.parquet(path)
    staged = staging.stg_orders(spark.read.parquet(path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = staged.select("order_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    for rule in ("LessThanOrEqual(discount,0.5", "GreaterThan(unit_price,0", "LessThanOrEqual(quantity,5)"):
        assert rule in pushed
    assert "payment_method" not in plan
    assert [r.order_id for r in staged.collect()] == ["a"]
