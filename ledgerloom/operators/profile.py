"""Column and table profiles. Each profile is one aggregation per table, turned into rows afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.operators.ranking import edges_by_measure, known_values


def _quoted(name: str):
    return F.col(f"`{name}`")


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, NULLs, their percentage, values that are not NULL."""
    counts = [F.count(_quoted(name)).alias(f"filled_{i}") for i, name in enumerate(df.columns)]
    totals = df.agg(F.count("*").alias("rows"), *counts)
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(f"filled_{i}").alias("filled"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    nulls = F.col("rows") - F.col("filled")
    return totals.select("rows", F.inline(F.array(*entries))).select(
        "position",
        "column_name",
        "data_type",
        "filled",
        nulls.alias("nulls"),
        F.bround(F.try_divide(nulls.cast("double"), F.col("rows").cast("double")) * 100, 2).alias("null_pct"),
    )


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return null_profile(df).where("nulls > 0")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([null_profile(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()])


def fingerprint(df: DataFrame) -> list[Column]:
    """Two hashes of a whole row, 128 bits together. Equal rows have equal prints; a mask of the NULLs is hashed too."""
    nulls = F.concat(*[F.when(_quoted(c).isNull(), "1").otherwise("0") for c in df.columns])
    values = [_quoted(c) for c in df.columns]
    return [F.xxhash64(nulls, *values).alias("_print_a"), F.xxhash64(F.lit("second"), *reversed(values), nulls).alias("_print_b")]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column, as one number.

    Prints of 16 bytes are counted first; only rows whose print occurs more than once are compared as a whole.
    """
    printed = df.select(*fingerprint(df), F.struct(*[_quoted(c) for c in df.columns]).alias("_row"))
    repeated = printed.groupBy("_print_a", "_print_b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_print_a", "_print_b")
    suspects = printed.join(repeated, ["_print_a", "_print_b"], "left_semi")
    copies = suspects.groupBy("_print_a", "_print_b", "_row").agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def duplicate_rows_by_table(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([duplicate_rows(df).select(F.lit(n).alias("table_name"), "*") for n, df in tables.items()])


def differing_rows(copies: dict[str, DataFrame], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Per pair of copies of a table, the rows that one has and the other has not, counted as often as they occur.

    One row with a number per pair: what ``exceptAll`` leaves in both directions together. Whole rows are compared, and
    all copies meet in one shuffle, whatever the number of pairs. NULLs are equal.
    """
    columns = next(iter(copies.values())).columns
    rows = union_all([df.select(*[_quoted(c) for c in columns], F.lit(name).alias("_copy")) for name, df in copies.items()])
    signs = {
        f"_{i}": (F.col("_copy") == one).cast("int") - (F.col("_copy") == other).cast("int")
        for i, (one, other) in enumerate(pairs.values())
    }
    signed = rows.select(*[_quoted(c) for c in columns], *[sign.alias(i) for i, sign in signs.items()])
    excess = signed.groupBy(*[_quoted(c) for c in columns]).agg(*[F.sum(i).alias(i) for i in signs])
    totals = [F.coalesce(F.sum(F.abs(F.col(i))), F.lit(0)).alias(name) for i, name in zip(signs, pairs)]
    return excess.select(*signs).agg(*totals)


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
            )
            for name, df in tables.items()
        ]
    )


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 3) -> DataFrame:
    """The first rows by a stated order."""
    return df.orderBy(*[_quoted(c) for c in order_by]).limit(rows)


def _figures(field: T.StructField, edges: Column) -> Column:
    """Count, mean, standard deviation, least and greatest value, and outliers of a column, as one value."""
    c = _quoted(field.name)
    value, own = c.cast("double"), F.try_element_at(edges, F.lit(field.name))
    fence = (own[3] - own[1]) * 1.5
    # Decimals and whole numbers add up exactly, whatever the order of the tasks.
    exact = isinstance(field.dataType, (T.DecimalType, T.IntegralType))
    return F.struct(
        F.lit(field.name).alias("measure"),
        F.count(c).alias("count"),
        (F.try_divide(F.sum(c).cast("double"), F.count(c)) if exact else F.avg(c)).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
        F.count_if((value < own[1] - fence) | (value > own[3] + fence)).alias("iqr_outliers"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Descriptive statistics with exact quartiles and the outlier count, rounded to three digits.

    An outlier lies beyond 1.5 times the interquartile range. NULL and NaN are missing values: they are in no figure.
    A column without values has zeros and NULLs. Three readings of the columns, none of which shuffles rows: sketch,
    quartiles, figures.
    """
    measures = {c: _quoted(c) for c in columns}
    values = known_values(df, measures)
    with_edges = values.withColumn("_edges", edges_by_measure(df, measures, 4))
    figures = F.array(*[_figures(f, F.col("_edges")) for f in values.schema])
    edges = F.first("_edges", ignorenulls=True).alias("edges")
    rows = with_edges.agg(figures.alias("figures"), edges).select("edges", F.inline("figures"))
    quartile = {"p25": 2, "p50": 3, "p75": 4}
    own = F.try_element_at("edges", F.col("measure"))
    rows = rows.withColumns({name: F.try_element_at(own, F.lit(i)) for name, i in quartile.items()})
    numbers = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return rows.select("measure", "count", *[F.bround(c, 3).alias(c) for c in numbers], "iqr_outliers")


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values beyond 1.5 times the interquartile range, per column. NULL and NaN are none."""
    return describe(df, columns).select("measure", "iqr_outliers")
