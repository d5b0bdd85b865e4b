"""Small expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x20\x09-\x0D]+"


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``row``, so that an operator's own columns cannot clash with them."""
    return F.struct(*[quoted(c) for c in df.columns]).alias("row")


def text_or_empty(name: str) -> Column:
    return F.coalesce(quoted(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words; null counts as no words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def scattered(key: Column, instead: Column | None = None) -> Column:
    """A hex string that orders keys as if at random, the same in every run and in SQL. Null keys use ``instead``."""
    text = key.cast("string")
    return F.md5(F.coalesce(text, instead, F.lit("")) if instead is not None else F.coalesce(text, F.lit("")))


def exact_id(name: str) -> list[Column]:
    """An id as two columns without nulls, ``id`` and ``named``: with a null in it, pandas would read it as doubles."""
    own = quoted(name).cast("long")
    return [F.coalesce(own, F.lit(0).cast("long")).alias("id"), own.isNotNull().alias("named")]
