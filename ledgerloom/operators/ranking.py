"""Exact order statistics without a global sort: running totals, tiles by rank, quantiles and bins by value.

An un-partitioned window or the exact ``percentile`` aggregate brings a whole column into one task. Here rows are
range-partitioned, counted per range, and each range is told what lies before it. Quantiles look only at the values
near the wanted ranks: a mergeable sketch says which those are, all others are merely counted. Nothing runs while a
frame is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

ACCURACY = 10_000  # the sketch's ranks are off by one part in this many rows at most
SLACK = 4 / ACCURACY


def running_totals(df: DataFrame, group: str, order_by: Sequence[str], weight: str) -> DataFrame:
    """Add ``last`` and ``total``: the weight up to and with each row in its group's order, and of the whole group.

    ``order_by`` must order the rows of a group without ties; weights are whole numbers above 0. Rows are dealt out by
    ranges of group and order, as evenly as they are distinct. The last row of each range sends the range's weight to
    every range; there what came from earlier ranges is added up. So every row goes through three shuffles, no task
    sees more than a range, and the counts never leave the plan.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.spark_partition_id()
    # A marker reaches the ranges it knows of; more of them than asked for would go without.
    checked = F.when(number < ranges, number).otherwise(F.raise_error(F.lit("more ranges than shuffle partitions")).cast("int"))
    ranged = df.repartitionByRange(ranges, group, *order_by).withColumn("_range", checked)
    whole = Window.partitionBy("_range", group)
    so_far = whole.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = ranged.withColumns({"_so_far": F.sum(weight).over(so_far), "_size": F.sum(weight).over(whole)})
    own = F.struct(
        F.col("_range").alias("to"), F.lit(None).cast("int").alias("since"), F.lit(None).cast("bigint").alias("size"),
        F.col("_so_far").alias("so_far"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
    )
    row_type = df.schema.simpleString()

    def marker(to: Column) -> Column:
        return F.struct(
            to.alias("to"), F.col("_range").alias("since"), F.col("_size").cast("bigint").alias("size"),
            F.lit(None).cast("bigint").alias("so_far"), F.lit(None).cast(row_type).alias("row"),
        )

    markers = F.transform(F.sequence(F.lit(0), F.lit(ranges - 1)), marker)
    is_last = F.col("_so_far") == F.col("_size")
    sent = F.when(is_last, F.concat(F.array(own), markers)).otherwise(F.array(own))
    gathered = counted.select(F.col(group).alias("_group"), F.explode(sent).alias("e")).select("_group", "e.*")
    here = Window.partitionBy("to", "_group")
    before = F.coalesce(F.sum(F.when(F.col("since") < F.col("to"), F.col("size"))).over(here), F.lit(0))
    placed = gathered.withColumns({"_before": before, "total": F.sum("size").over(here)}).where("since IS NULL")
    return placed.select("row.*", (F.col("_before") + F.col("so_far")).alias("last"), "total")


def _value_type(df: DataFrame, measures: dict[str, Column]) -> str:
    """One type that holds all measures without loss: a decimal for whole numbers and decimals, else a double.

    Whole numbers next to doubles, and decimals that need more than 38 digits together, are compared as doubles.
    """
    whole = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    before, after = 1, 0
    for field in df.select(*[c.alias(name) for name, c in measures.items()]).schema:
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            before, after = max(before, kind.precision - kind.scale), max(after, kind.scale)
        elif type(kind) in whole:
            before = max(before, whole[type(kind)])
        else:
            return "double"
    return f"decimal({before + after},{after})" if before + after <= 38 else "double"


def tile_by_rank(df: DataFrame, id_column: str, measures: dict[str, Column], tiles: int = 5) -> DataFrame:
    """Add ``<name>_tile`` per measure, equal to ``ntile(tiles)`` ordered by the measure, NULLs last, then the id.

    The id must be unique. Every measure is ranked on its own; the rows travel with the first of them and meet their
    other tiles by id, so ``df`` is computed once.
    """
    kind = _value_type(df, measures)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    row_type = df.schema.simpleString()
    entries = [
        F.struct(
            F.lit(i).alias("measure"),
            c.isNull().alias("missing"),
            c.cast(kind).alias("value"),
            (row if i == 0 else F.lit(None)).cast(row_type).alias("row"),
        )
        for i, c in enumerate(measures.values())
    ]
    keys = df.select(F.col(id_column).alias("id"), F.inline(F.array(*entries))).withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_totals(keys, "measure", ["missing", "value", "id"], "one")
    place, n = F.col("last") - 1, F.col("total")
    size, larger = F.floor(n / tiles), n % tiles  # the first ``larger`` tiles hold one row more
    tile = F.when(place < larger * (size + 1), F.floor(place / (size + 1))).otherwise(
        larger + F.floor((place - larger * (size + 1)) / F.greatest(size, F.lit(1)))
    )
    tiled = ranked.withColumn("tile", (tile + 1).cast("int"))
    each = [F.max(F.when(F.col("measure") == i, F.col("tile"))).alias(f"{name}_tile") for i, name in enumerate(measures)]
    met = tiled.groupBy("id").agg(F.first("row", ignorenulls=True).alias("row"), *each)
    return met.select("row.*", *[f"{name}_tile" for name in measures])


def known(c: Column, kind: T.DataType) -> Column:
    """The value, or NULL for NaN: a missing number, as in a data frame."""
    return F.when(~F.isnan(c), c) if isinstance(kind, (T.DoubleType, T.FloatType)) else c


def known_values(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """The measures as columns of their own, without NaN."""
    named = df.select(*[c.alias(name) for name, c in measures.items()])
    return named.select(*[known(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in named.schema])


def _brackets(values: DataFrame, parts: int) -> DataFrame:
    """One row per measure (by place): arrays ``low`` and ``high`` of the intervals that hold the wanted ranks.

    The sketch's error is bounded, so widening each rank by several times that is enough. Up to ``ACCURACY`` values
    are all looked at.
    """
    shares = [t / parts for t in range(parts + 1)]
    wanted = [max(0.0, s - SLACK) for s in shares], [min(1.0, s + SLACK) for s in shares]

    def of(i: int, name: str) -> Column:
        value = F.col(f"`{name}`").cast("double")
        sketched = F.percentile_approx(value, wanted[0] + wanted[1], ACCURACY)
        few = F.count(value) <= ACCURACY
        low = [F.lit(float("-inf")), *[F.when(~few, sketched[t]).otherwise(float("-inf")) for t in range(1, parts + 1)]]
        high = [*[F.when(~few, sketched[parts + 1 + t]).otherwise(float("inf")) for t in range(parts)], F.lit(float("inf"))]
        return F.struct(F.lit(i).alias("measure"), F.array(*low).alias("low"), F.array(*high).alias("high"))

    return values.agg(F.array(*[of(i, name) for i, name in enumerate(values.columns)]).alias("b")).select(F.inline("b"))


def quantiles(df: DataFrame, measures: dict[str, Column], parts: int) -> DataFrame:
    """Exact linear-interpolated quantiles 0/parts … parts/parts per measure that has values.

    Gives measure, n (values that are neither NULL nor NaN) and ``edges``, an array of ``parts + 1`` doubles. The
    table is read twice: for the sketch, and for the values in its brackets; values between two brackets are one row
    with their number before the shuffle, as are equal values.
    """
    values = known_values(df, measures)
    kind = _value_type(values, {c: F.col(f"`{c}`") for c in values.columns})
    entries = [F.struct(F.lit(i).alias("measure"), F.col(f"`{c}`").cast(kind).alias("value")) for i, c in enumerate(values.columns)]
    long = values.select(F.inline(F.array(*entries))).where("value IS NOT NULL").withColumn("place", F.col("value").cast("double"))
    near = long.join(F.broadcast(_brackets(values, parts)), "measure")  # a row per measure
    place, held, below = F.col("place"), F.lit(False), [F.lit(float("-inf"))]
    for t in range(parts + 1):
        low, high = F.col("low")[t], F.col("high")[t]
        held = held | ((low <= place) & (place <= high))
        below.append(F.when(high < place, high))
    keys = near.withColumn("held", held).select(
        "measure",
        F.when(F.col("held"), place).otherwise(F.greatest(*below)).alias("place"),
        (~F.col("held")).alias("between"),
        F.when(F.col("held"), F.col("value")).alias("value"),
    )
    counted = keys.groupBy("measure", "place", "between", "value").agg(F.count(F.lit(1)).alias("weight"))
    ranked = running_totals(counted, "measure", ["place", "between", "value"], "weight")

    def rank(t: int, rounded) -> Column:
        return (rounded((F.col("total") - 1) * t / parts) + 1).cast("bigint")

    def at(rank: Column) -> Column:
        here = (F.col("last") >= rank) & (F.col("last") - F.col("weight") < rank)
        missed = F.raise_error(F.lit("a wanted rank lies outside of its bracket")).cast("double")
        return F.max(F.when(here & F.col("between"), missed).when(here, F.col("value").cast("double")))

    found = ranked.groupBy("measure").agg(
        F.max("total").alias("n"),
        F.array(*[at(rank(t, F.floor)) for t in range(parts + 1)]).alias("low"),
        F.array(*[at(rank(t, F.ceil)) for t in range(parts + 1)]).alias("high"),
    )

    def edge(pair: Column, t: Column) -> Column:
        low, high = pair["low"], pair["high"]
        share = F.pmod((F.col("n") - 1) * t, F.lit(parts)) / parts
        # Interpolate from the nearer end, as numpy does; equal ends give exactly that value.
        between = F.when(share < 0.5, low + (high - low) * share).otherwise(high - (high - low) * (1 - share))
        return F.when(low == high, low).otherwise(between)

    edges = F.transform(F.arrays_zip("low", "high"), edge)
    names = F.array(*[F.lit(name) for name in measures])
    return found.select(names[F.col("measure")].alias("measure"), "n", edges.alias("edges"))


def edges_by_measure(df: DataFrame, measures: dict[str, Column], parts: int) -> Column:
    """The quantiles as one value: a map from measure to edges."""
    return quantiles(df, measures, parts).agg(F.map_from_entries(F.collect_list(F.struct("measure", "edges")))).scalar()


def bins_by_quantile(df: DataFrame, measures: dict[str, Column], bins: int = 5) -> DataFrame:
    """Add ``<name>_bin`` per measure: 1 for the lowest values to ``bins`` for the highest, equal values together.

    Bins are closed on the right; NULL and NaN have none. Two equal edges leave a bin without a range; that is an
    error.
    """
    kinds = df.select(*[c.alias(name) for name, c in measures.items()]).schema

    def bin_of(name: str, c: Column) -> Column:
        own = F.try_element_at(F.col("_edges"), F.lit(name))
        value = known(c, kinds[name].dataType).cast("double")
        number = F.size(F.filter(F.slice(own, 2, bins - 1), lambda e: e < value)) + 1
        repeated = F.size(F.array_distinct(own)) < bins + 1
        return (
            F.when(value.isNull(), None)
            .when(repeated, F.raise_error(F.lit(f"bin edges of {name} must be unique")).cast("int"))
            .otherwise(number)
        )

    return (
        df.withColumn("_edges", edges_by_measure(df, measures, bins))
        .withColumns({f"{name}_bin": bin_of(name, c) for name, c in measures.items()})
        .drop("_edges")
    )
