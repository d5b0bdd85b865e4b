import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.config import COUNTRY_ALIASES
from ledgerloom.functions import calendar, display, measures, text


def values(spark, rows, kind, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_country_aliases_match_before_blanks_are_removed(spark):
    raw = ["Deutschland", " FR ", "FR", "españa", "España", None]
    clean = values(spark, raw, "string", lambda c: text.title_case(text.strip(text.replace_exact(c, COUNTRY_ALIASES))))
    assert clean == ["Germany", "Fr", "France", "España", "Spain", None]


def test_title_case_and_strip(spark):
    raw = ["o'neil mobile-app", "3d print", " home & living ", "\t tab\n", ""]
    assert values(spark, raw, "string", lambda c: text.title_case(text.strip(c))) == [
        "O'Neil Mobile-App", "3D Print", "Home & Living", "Tab", "",
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ '-_0 9éñ&", max_size=15), min_size=20, max_size=40))
def test_title_case_equals_python(spark, raw):
    assert values(spark, raw, "string", text.title_case) == [r.title() for r in raw]


def test_snake_case():
    assert [text.snake_case(h) for h in ("Order ID", " Sub-Category ", "Year-Month")] == [
        "order_id", "sub-category", "year-month",
    ]


def test_clip_keeps_null(spark):
    raw = [Decimal("-0.2"), Decimal("0"), Decimal("0.3"), Decimal("0.7"), None]
    clipped = values(spark, raw, "decimal(6,4)", lambda c: measures.clip(c, "0", "0.5").cast("double"))
    assert clipped == [0.0, 0.0, 0.3, 0.5, None]


TIER_INPUT = [None if t is None else Decimal(t) for t in ("-0.005", "0", "0.1", "0.10001", "0.3", "0.5", "0.6", None)]


def test_tiers_by_case(spark):
    assert values(spark, TIER_INPUT, "decimal(8,5)", measures.discount_tier_by_case) == [
        "1-10%", "No discount", "1-10%", "11-20%", "21-30%", "31-50%", "31-50%", "31-50%",
    ]


def test_tiers_by_bins(spark):
    assert values(spark, TIER_INPUT, "decimal(8,5)", measures.discount_tier_by_bins) == [
        "No discount", "No discount", "1–10%", "11–20%", "21–30%", "31–50%", None, None,
    ]


def test_segments(spark):
    assert values(spark, [3, 4, 7, 10, 13], "int", measures.rfm_segment) == [
        "At Risk", "Needs Attention", "Potential Loyalists", "Loyal Customers", "Champions",
    ]


def test_fiscal_calendar(spark):
    days = [datetime.date(2024, m, 1) for m in (1, 6, 7, 12)]
    assert values(spark, days, "date", calendar.fiscal_quarter) == [3, 4, 1, 2]
    assert values(spark, days, "date", calendar.fiscal_year) == [2024, 2024, 2025, 2025]


def test_calendar_text(spark):
    day = [datetime.date(2024, 12, 30)]
    assert values(spark, day, "date", F.weekofyear) == [1]
    assert values(spark, day, "date", calendar.year_quarter) == ["2024-Q4"]
    assert values(spark, [datetime.date(2024, 5, 1)], "date", lambda c: calendar.month_name(c, True)) == ["May      "]
    assert values(spark, [datetime.date(2024, 5, 1)], "date", calendar.month_name) == ["May"]


def test_bad_date_is_null_or_an_error(spark):
    assert values(spark, ["abc", "2024-01-31", None], "string", calendar.parse_date_or_null) == [
        None, datetime.date(2024, 1, 31), None,
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["abc"], "string", lambda c: c.cast("date"))


def test_margin_and_ratio_guards(spark):
    df = spark.createDataFrame(
        [(Decimal("5"), Decimal("0")), (None, Decimal("2")), (Decimal("1"), Decimal("8"))], "p decimal(18,6), n decimal(18,6)"
    )
    margins = [r.m for r in df.select(measures.margin(F.col("p"), F.col("n")).cast("double").alias("m")).collect()]
    ratios = [r.m for r in df.select(measures.ratio(F.col("p"), F.col("n")).cast("double").alias("m")).collect()]
    assert margins == [0.0, None, 0.125]
    assert ratios == [None, None, 0.125]


def test_report_texts_equal_python_formatting(spark):
    numbers = [0.5, 1.5, 1234567.891, 98.25, 0.125, 0.0]
    assert values(spark, numbers, "double", display.euros) == [f"€{x:,.0f}" for x in numbers]
    assert values(spark, numbers, "double", lambda c: display.euros(c, 2)) == [f"€{x:,.2f}" for x in numbers]
    assert values(spark, numbers, "double", display.percent) == [f"{x:.1%}" for x in numbers]
    assert values(spark, numbers, "double", display.signed_percent) == [f"+{x:.1f}%" for x in numbers]
    assert values(spark, [0, 5127], "bigint", display.whole) == ["0", "5,127"]
