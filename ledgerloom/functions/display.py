"""Numbers as report text. ``format_number`` rounds halves to even, as the published figures do."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def euros(amount: Column, digits: int = 0) -> Column:
    return F.concat(F.lit("€"), F.format_number(amount.cast("double"), digits))


def plain_percent(value: Column, digits: int = 1) -> Column:
    """``12.345`` as ``12.3%``, without thousands separators."""
    return F.concat(F.replace(F.format_number(value.cast("double"), digits), F.lit(","), F.lit("")), F.lit("%"))


def percent(share: Column, digits: int = 1) -> Column:
    """``0.12345`` as ``12.3%``."""
    return plain_percent(share.cast("double") * 100, digits)


def signed_percent(value: Column) -> Column:
    """The sign is always a plus, whatever the value."""
    return F.concat(F.lit("+"), plain_percent(value))


def whole(count: Column) -> Column:
    return F.format_number(count, 0)
