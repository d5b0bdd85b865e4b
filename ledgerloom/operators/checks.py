"""Data checks in two styles, each table read once for all its checks.

Report checks treat a missing value as a violation and count violating rows. Column tests ignore missing values
(except ``not_null``) and count failures: duplicated values, bad values, rows without a parent.

Every row is counted once per key column, once by which row-wise checks fail, and once per listed value, all in one
aggregation: equal keys leave a task as one row, and the counts of parent and child meet by key. That answers
uniqueness and foreign keys alike; no table is joined to another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.functions.measures import is_true
from ledgerloom.operators.dedup import copies_per_key
from ledgerloom.operators.profile import union_all

LISTED = 5  # offending values named in a report
SLOTS = 4096


@dataclass(frozen=True)
class RowCheck:
    """``holds`` must be true in every row. ``listed`` names a column whose offending values go into the detail,
    ``counted`` a label and a condition whose rows are counted there."""

    label: str
    table: str
    name: str
    holds: Column
    listed: str | None = None
    counted: tuple[str, Column] | None = None


@dataclass(frozen=True)
class UniqueCheck:
    """Rows beyond the first per key are violations; two NULLs are duplicates."""

    label: str
    table: str
    name: str
    key: str


@dataclass(frozen=True)
class ForeignKeyCheck:
    """Rows whose key the parent has not got. A NULL key is missing unless the parent has one as well."""

    label: str
    table: str
    name: str
    key: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class ColumnTest:
    """One declared test of a column: ``unique``, ``not_null``, ``accepted_values`` or ``relationships``."""

    table: str
    column: str
    kind: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""


@dataclass
class Tally:
    """What is counted, and the figures that are read from the counts.

    A domain is a set of keys with two counts per key: rows of its parent side and rows of its child side.
    """

    domains: list[str] = field(default_factory=list)
    counted: dict[str, list[tuple[int, str, Column]]] = field(default_factory=dict)
    keys: dict[tuple[str, str], tuple[int, str]] = field(default_factory=dict)
    flags: dict[str, list[Column]] = field(default_factory=dict)

    def domain(self, name: str) -> int:
        if name not in self.domains:
            self.domains.append(name)
        return self.domains.index(name)

    def count(self, table: str, domain: int, side: str, key: Column) -> None:
        self.counted.setdefault(table, []).append((domain, side, key))

    def key_pair(self, parent: str, parent_key: str, child: str, key: str) -> int:
        name = f"{parent}.{parent_key} <- {child}.{key}"
        known = name in self.domains
        domain = self.domain(name)
        for table, column, side in () if known else ((parent, parent_key, "parent"), (child, key, "child")):
            self.count(table, domain, side, F.col(f"`{column}`"))
            self.keys.setdefault((table, column), (domain, side))
        return domain

    def key(self, table: str, column: str) -> tuple[int, str]:
        """Domain and side that count this key; a domain of its own if no pair does."""
        if (table, column) not in self.keys:
            self.keys[table, column] = (self.domain(f"{table}.{column}"), "parent")
            self.count(table, self.keys[table, column][0], "parent", F.col(f"`{column}`"))
        return self.keys[table, column]

    def listing(self, table: str, name: str, bad_value: Column) -> int:
        """A domain of offending values; NULL for rows that do not offend."""
        domain = self.domain(f"{table}.{name} listed {len(self.domains)}")
        self.count(table, domain, "parent", bad_value.cast("string"))
        return domain

    def flag(self, table: str, condition: Column) -> Column:
        """The number of rows that satisfy ``condition``, as an aggregate of the counts."""
        own = self.flags.setdefault(table, [])
        own.append(condition)
        bit = len(own) - 1
        if bit > 61:
            raise ValueError(f"too many row-wise checks of {table}")
        holds = F.col("number").bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0
        return self.total(self.domain(f"{table} rows"), F.when(holds, F.col("parent")))

    @staticmethod
    def total(domain: int, value: Column) -> Column:
        return F.sum(F.when(F.col("domain") == domain, value).otherwise(F.lit(0)).cast("bigint"))

    def counts(self, tables: dict[str, DataFrame]) -> DataFrame:
        """domain, number and key (whole numbers in the first, all else as text), parent, child."""
        counted = {t: list(own) for t, own in self.counted.items()}
        for table, conditions in self.flags.items():
            mask = F.lit(0).cast("bigint")
            for bit, condition in enumerate(conditions):
                mask = mask + F.when(condition, F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            counted.setdefault(table, []).append((self.domain(f"{table} rows"), "parent", mask))
        # A domain holds whole numbers if all its keys do, so that equal keys of two tables are equal here.
        kinds = {t: tables[t].select(*[key for _, _, key in own]).schema for t, own in counted.items()}
        whole = {
            d for d in range(len(self.domains))
            if all(isinstance(f.dataType, T.IntegralType) for t, own in counted.items() for (of, _, _), f in zip(own, kinds[t]) if of == d)
        }

        def entry(domain: int, side: str, key: Column) -> Column:
            number = key.cast("bigint") if domain in whole else F.lit(None).cast("bigint")
            text = F.lit(None).cast("string") if domain in whole else key.cast("string")
            counts = [F.lit(1 if side == s else 0).cast("bigint").alias(s) for s in ("parent", "child")]
            return F.struct(F.lit(domain).alias("domain"), number.alias("number"), text.alias("key"), *counts)

        rows = union_all([tables[t].select(F.inline(F.array(*[entry(*e) for e in own]))) for t, own in counted.items()])
        return rows.groupBy("domain", "number", "key").agg(F.sum("parent").alias("parent"), F.sum("child").alias("child"))


def _filled() -> Column:
    return F.col("number").isNotNull() | F.col("key").isNotNull()


def _figures(counts: DataFrame, figures: dict[str, Column], listed: dict[str, int]) -> DataFrame:
    """One row: the figures, and for each listed domain (by name) ``{n, least}``: how many keys, and the smallest.

    The smallest are found per slot of a hash first, so no task holds more than a slot's keys.
    """
    sums = [c.alias(name) for name, c in figures.items()]
    if not listed:
        return counts.agg(*sums)

    def own(domain: int) -> Column:
        return (F.col("domain") == domain) & F.col("key").isNotNull()

    # First one row for all that is not listed, by plain hash aggregation; then the lists, which are short by comparison.
    is_listed = F.col("key").isNotNull() & F.col("domain").isin(*listed.values())
    shown = F.when(is_listed, F.struct("domain", "key")).alias("shown")
    summed = counts.groupBy(shown).agg(*sums).select("shown.domain", "shown.key", *figures)
    slot = summed.groupBy(F.when(F.col("key").isNotNull(), F.pmod(F.xxhash64("key"), F.lit(SLOTS))).alias("slot")).agg(
        *[F.sum(name).alias(name) for name in figures],
        *[F.count_if(own(d)).alias(f"{name} n") for name, d in listed.items()],
        *[F.slice(F.sort_array(F.collect_list(F.when(own(d), F.col("key")))), 1, LISTED).alias(f"{name} least") for name, d in listed.items()],
    )
    return slot.agg(
        *[F.sum(name).alias(name) for name in figures],
        *[
            F.struct(
                F.sum(f"`{name} n`").alias("n"),
                F.slice(F.sort_array(F.flatten(F.collect_list(f"`{name} least`"))), 1, LISTED).alias("least"),
            ).alias(name)
            for name in listed
        ],
    )


def _named(found: Column) -> Column:
    more = F.greatest(found["n"] - LISTED, F.lit(0))
    rest = F.when(more > 0, F.concat(F.lit(" and "), more.cast("string"), F.lit(" more"))).otherwise("")
    return F.concat(F.lit("invalid values: "), F.array_join(found["least"], ", "), rest)


def no_nulls(df: DataFrame) -> Column:
    holds = F.lit(True)
    for name in df.columns:
        holds = holds & F.col(f"`{name}`").isNotNull()
    return holds


def report(tables: dict[str, DataFrame], checks: Sequence[RowCheck | UniqueCheck | ForeignKeyCheck]) -> DataFrame:
    """One row per check: table, check, passed, violations, detail."""
    tally, figures, listed = Tally(), {}, {}
    for check in checks:
        if isinstance(check, ForeignKeyCheck):
            tally.key_pair(check.parent, check.parent_key, check.table, check.key)
    for i, check in enumerate(checks):
        if isinstance(check, RowCheck):
            figures[f"v{i}"] = tally.flag(check.table, ~is_true(check.holds))
            if check.counted:
                figures[f"c{i}"] = tally.flag(check.table, is_true(check.counted[1]))
            if check.listed:
                listed[f"l{i}"] = tally.listing(check.table, check.listed, F.when(~is_true(check.holds), F.col(f"`{check.listed}`")))
        elif isinstance(check, UniqueCheck):
            domain, side = tally.key(check.table, check.key)
            figures[f"v{i}"] = tally.total(domain, F.greatest(F.col(side) - 1, F.lit(0)))
        else:
            domain = tally.key_pair(check.parent, check.parent_key, check.table, check.key)
            figures[f"v{i}"] = tally.total(domain, F.when(F.col("parent") == 0, F.col("child")))
    totals = _figures(tally.counts(tables), figures, listed)

    def detail(i: int, check) -> Column:
        if f"c{i}" in figures:
            return F.concat(F.lit(f"{check.counted[0]}: "), F.coalesce(f"c{i}", F.lit(0)).cast("string"))
        return _named(F.col(f"l{i}")) if f"l{i}" in listed else F.lit("")

    entries = [
        F.struct(
            F.lit(check.label).alias("table_name"),
            F.lit(check.name).alias("check_name"),
            F.coalesce(f"v{i}", F.lit(0)).alias("violations"),
            detail(i, check).alias("detail"),
        )
        for i, check in enumerate(checks)
    ]
    rows = totals.select(F.inline(F.array(*entries)))
    return rows.select("table_name", "check_name", (F.col("violations") == 0).alias("passed"), "violations", "detail")


def report_summary(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if("passed").alias("passed"), F.count("*").alias("checks"))


def unaccepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their number of rows. NULL is accepted."""
    counted = df.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count("*").alias("rows"))
    return counted.where(~F.col("value").isin(*values)).select(
        F.lit(column).alias("column_name"), F.col("value").cast("string"), "rows"
    )


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, NULL left aside."""
    return copies_per_key(df.where(F.col(f"`{column}`").isNotNull()), [column])


def run_column_tests(tables: dict[str, DataFrame], tests: Sequence[ColumnTest]) -> DataFrame:
    """One row per test: table, column, test, failures, passed. Every table is read once."""
    tally, figures = Tally(), []
    for t in tests:
        if t.kind == "relationships":
            tally.key_pair(t.parent, t.parent_column, t.table, t.column)
    for t in tests:
        column = F.col(f"`{t.column}`")
        if t.kind == "not_null":
            figures.append(tally.flag(t.table, column.isNull()))
        elif t.kind == "accepted_values":
            domain = tally.listing(t.table, t.column, F.when(~column.isin(*t.values), column))
            figures.append(tally.total(domain, F.when(_filled(), 1)))
        elif t.kind == "unique":
            domain, side = tally.key(t.table, t.column)
            figures.append(tally.total(domain, F.when(_filled() & (F.col(side) > 1), 1)))
        elif t.kind == "relationships":
            domain = tally.key_pair(t.parent, t.parent_column, t.table, t.column)
            figures.append(tally.total(domain, F.when(_filled() & (F.col("parent") == 0), F.col("child"))))
        else:
            raise ValueError(f"unknown test {t.kind!r}")
    totals = _figures(tally.counts(tables), {f"f{i}": c for i, c in enumerate(figures)}, {})
    entries = [
        F.struct(
            F.lit(t.table).alias("table_name"),
            F.lit(t.column).alias("column_name"),
            F.lit(t.kind).alias("test_name"),
            F.coalesce(f"f{i}", F.lit(0)).alias("failures"),
        )
        for i, t in enumerate(tests)
    ]
    return totals.select(F.inline(F.array(*entries))).withColumn("passed", F.col("failures") == 0)
