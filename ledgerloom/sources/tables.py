"""Read the five raw tables of a data set, cleaned files, and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.text import with_snake_case_columns
from ledgerloom.sources.schemas import CORRUPT, RAW_COLUMNS, raw_schema, typed_schema

TABLES = tuple(RAW_COLUMNS)


def load_tables(spark: SparkSession, folder: str, file_format: str = "csv", dates: str = "text") -> dict[str, DataFrame]:
    """All raw tables under ``folder/<table>``, with snake_case names.

    Text files get the declared schema, never an inferred one. Parquet files carry their own types; reading
    them as they are keeps filters on the stored columns, which reach the row groups.

    ``dates`` says what becomes of dates in text files: ``text`` leaves them to the plans; ``raise`` reads them as
    dates, and a record that does not fit the schema is an error; ``keep`` reads on with NULLs and puts such a record,
    whole, into the column ``_corrupt_record``.
    """
    if file_format == "parquet":
        return {t: with_snake_case_columns(spark.read.parquet(f"{folder}/{t}")) for t in TABLES}
    if file_format != "csv":
        raise ValueError(f"unknown file format {file_format!r}")
    if dates not in ("text", "raise", "keep"):
        raise ValueError(f"unknown treatment of dates {dates!r}")
    mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} if dates == "keep" else {"mode": "FAILFAST"}
    reader = spark.read.options(header=True, dateFormat="yyyy-MM-dd", **mode)

    def schema(table: str):
        return raw_schema(table) if dates == "text" else typed_schema(table, corrupt=dates == "keep")

    return {t: with_snake_case_columns(reader.schema(schema(t)).csv(f"{folder}/{t}")) for t in TABLES}


def corrupt_records(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table read with ``dates="keep"``: records, and those that ``dates="raise"`` would stop at."""
    counts = [
        # The count of a filled column makes the reader parse the record; it never parses for the corrupt column alone.
        df.select(*df.columns).agg(F.count(F.lit(1)).alias("records"), F.count(F.when(F.col(CORRUPT).isNotNull(), F.struct(*df.columns))).alias("corrupt"))
        .select(F.lit(name).alias("table_name"), "records", "corrupt")
        for name, df in tables.items()
    ]
    first, *rest = counts
    for df in rest:
        first = first.unionByName(df)
    return first


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def source_table(spark: SparkSession, name: str, database: str = "raw") -> DataFrame:
    """A declared source table of the catalog."""
    return spark.table(f"{database}.{name}")
