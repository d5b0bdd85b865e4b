"""Calendar and July-start fiscal attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FISCAL_START_MONTH = 7
MONTH_NAME_WIDTH = 9


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def year_quarter(d: Column) -> Column:
    return F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), F.quarter(d).cast("string"))


def month_name(d: Column, padded: bool = False) -> Column:
    """Full English month name; ``padded`` fills it up with blanks to nine characters."""
    name = F.date_format(d, "MMMM")
    return F.rpad(name, MONTH_NAME_WIDTH, " ") if padded else name


def fiscal_year(d: Column) -> Column:
    return fiscal_year_of(F.year(d), F.month(d))


def fiscal_quarter(d: Column) -> Column:
    return fiscal_quarter_of(F.month(d))


def fiscal_year_of(year: Column, month: Column) -> Column:
    return F.when(month >= FISCAL_START_MONTH, year + 1).otherwise(year)


def fiscal_quarter_of(month: Column) -> Column:
    return (F.floor(F.pmod(month - FISCAL_START_MONTH, F.lit(12)) / 3) + 1).cast("int")


def calendar_columns(d: Column, padded_month_name: bool = False) -> dict[str, Column]:
    """The nine attributes, by name."""
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": month_name(d, padded_month_name),
        "week": F.weekofyear(d),
        "year_month": year_month(d),
        "year_quarter": year_quarter(d),
        "fiscal_year": fiscal_year(d),
        "fiscal_quarter": fiscal_quarter(d),
    }


def parse_date_or_null(c: Column) -> Column:
    """A date, or NULL where the text is not one."""
    return c.try_cast("date")
