import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from ledgerloom.operators import checks, dedup, joins, profile, ranking


@pytest.fixture
def many_ranges(spark, monkeypatch):
    """Many ranges and narrow brackets on small data."""
    monkeypatch.setattr(ranking, "ACCURACY", 200)
    monkeypatch.setattr(ranking, "SLACK", 4 / 200)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def customers(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [
        (
            f"c{rng.randrange(10**9)}-{i}",
            None if rng.random() < 0.05 else rng.choice([1, 1, 1, 2, 3, 50]),
            Decimal(rng.randrange(-500, 10**7)) / 100,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id string, f int, m decimal(12,2)")


def assert_tiles_equal_ntile(df, tiles=5):
    got = ranking.tile_by_rank(df, "id", {"f": F.col("f"), "m": F.col("m")}, tiles)
    expected = df.select(
        "id",
        *[F.ntile(tiles).over(Window.orderBy(F.col(c).asc_nulls_last(), "id")).alias(f"{c}_want") for c in ("f", "m")],
    )
    wrong = got.join(expected, "id").where("f_tile <> f_want OR m_tile <> m_want")
    assert got.count() == df.count() and wrong.count() == 0


def test_tiles_equal_ntile_in_many_ranges(spark, many_ranges):
    assert_tiles_equal_ntile(customers(spark, 3000))


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 23])
def test_tiles_equal_ntile_on_few_rows(spark, n):
    assert_tiles_equal_ntile(customers(spark, n, seed=n))


def test_tile_sizes_with_null_last(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([3, 1, 1, 1, None, 2, 9])], "id int, v int")
    got = ranking.tile_by_rank(df, "id", {"v": F.col("v")}).orderBy(F.col("v").asc_nulls_last(), "id").collect()
    assert [r.v_tile for r in got] == [1, 1, 2, 2, 3, 4, 5]


def test_quantiles_equal_numpy_in_many_ranges(spark, many_ranges):
    df = customers(spark, 3000, seed=4)
    got = {r.measure: (r.n, r.edges) for r in ranking.quantiles(df, {"f": F.col("f"), "m": F.col("m")}, 5).collect()}
    pdf = df.toPandas()
    for c in ("f", "m"):
        v = pdf[c].dropna().astype(float)
        assert got[c][0] == len(v)
        assert np.allclose(got[c][1], v.quantile([0, 0.2, 0.4, 0.6, 0.8, 1]), rtol=0, atol=1e-9)


def test_bins_equal_qcut(spark, many_ranges):
    df = customers(spark, 1500, seed=5)
    got = ranking.bins_by_quantile(df, {"m": F.col("m")}).toPandas()
    want = pd.qcut(got.m.astype(float), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert (got.m_bin == want).all()


def test_bins_with_equal_edges_are_an_error(spark):
    df = spark.createDataFrame([(i, min(i, 3)) for i in range(20)], "id int, v int")
    with pytest.raises(Exception, match="bin edges of v must be unique"):
        ranking.bins_by_quantile(df, {"v": F.col("v")}).collect()


def test_nothing_runs_while_a_frame_is_built(spark):
    df = customers(spark, 50)
    group = "ranking-build"
    spark.sparkContext.setJobGroup(group, "")
    try:
        ranking.tile_by_rank(df, "id", {"f": F.col("f")})
        ranking.bins_by_quantile(df, {"m": F.col("m")})
        profile.describe(df, ["f", "m"])
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_running_totals_and_the_largest_range(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        for n in (500, 50_000):
            df = spark.range(n).select((F.col("id") % 3).alias("g"), F.expr("xxhash64(id)").alias("k"), (F.col("id") % 5 + 1).alias("w"))
            got = ranking.running_totals(df, "g", ["k"], "w").toPandas().sort_values(["g", "k"])
            assert (got["last"] == got.groupby("g").w.cumsum()).all() and (got.total == got.groupby("g").w.transform("sum")).all()
            sizes = df.repartitionByRange(16, "g", "k").groupBy(F.spark_partition_id()).count().toPandas()["count"]
            assert sizes.max() <= 2.5 * n / 16 + 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_values_between_brackets_are_only_counted(spark, many_ranges):
    df = spark.range(5000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    edges = ranking.quantiles(df, {"v": F.col("v")}, 4).first().edges
    assert edges == pytest.approx(np.quantile(np.arange(5000.0) ** 2, [0, 0.25, 0.5, 0.75, 1]).tolist(), rel=1e-15)


def test_quantiles_of_tiny_huge_and_missing_numbers(spark):
    numbers = [1e-8, 2e-8, 3.5e-8, 1e23, -1e23, 5e22, 0.0, -0.0, 1e-300, 7.25]
    rows = [(v,) for v in numbers] + [(float("nan"),), (None,)]
    df = spark.createDataFrame(rows, "v double")
    got = ranking.quantiles(df, {"v": F.col("v")}, 4).first()
    assert got.n == len(numbers) and got.edges == pytest.approx(np.quantile(numbers, [0, 0.25, 0.5, 0.75, 1]).tolist(), rel=1e-14)
    small = profile.describe(df.where("v < 1"), ["v"]).first()
    assert (small["count"], small.p50, small.iqr_outliers) == (7, 0.0, 1)
    binned = ranking.bins_by_quantile(spark.createDataFrame([*[(float(v),) for v in range(10)], (float("nan"),), (None,)], "v double"), {"v": F.col("v")})
    assert sorted((r.v_bin for r in binned.collect()), key=lambda b: b or 0) == [None, None, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_infinite_values_are_values(spark):
    df = spark.createDataFrame([(v,) for v in (float("-inf"), 1.0, 2.0, 3.0, float("inf"))], "v double")
    assert ranking.quantiles(df, {"v": F.col("v")}, 4).first().edges == [float("-inf"), 1.0, 2.0, 3.0, float("inf")]


def test_describe_of_nothing(spark):
    row = profile.describe(spark.createDataFrame([(None, float("nan"))], "a decimal(5,2), b double"), ["a", "b"]).collect()
    assert [(r["count"], r["mean"], r.p50, r.iqr_outliers) for r in row] == [(0, None, None, 0)] * 2


def test_keep_first_and_removed_count(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "z"), (None, "q"), (None, "p")], "id int, v string")
    first = {(r.id, r.v) for r in dedup.keep_first(df, ["id"]).collect()}
    assert first == {(1, "a"), (2, "z"), (None, "p")}
    assert dedup.removed_count(df, ["id"]).first().removed == 3
    again = dedup.keep_first(dedup.keep_first(df, ["id"]), ["id"])
    assert {(r.id, r.v) for r in again.collect()} == first


def test_keep_first_by_arrival(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1)], "id int, v string, seq int")
    assert dedup.keep_first(df, ["id"], ["seq"]).first().v == "b"


def test_iqr_outlier(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 100, None)], "v int")
    assert profile.iqr_outliers(df, ["v"]).first().iqr_outliers == 1
    with_nan = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)] + [(float("nan"),)], "v double")
    row = profile.describe(with_nan, ["v"]).first()
    assert (row["count"], row["mean"], row["max"], row.iqr_outliers) == (5, 22.0, 100.0, 1)


def test_describe_equals_pandas(spark):
    df = customers(spark, 500, seed=8).select("f", "m")
    got = {r.measure: r for r in profile.describe(df, ["f", "m"]).collect()}
    want = df.toPandas().astype(float).describe().T.round(3)
    for c in ("f", "m"):
        row = got[c]
        assert [row["count"], row["mean"], row["std"], row["min"], row.p25, row.p50, row.p75, row["max"]] == pytest.approx(
            want.loc[c].tolist()
        )


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "a int, `b-c` string")
    rows = {r.column_name: (r.nulls, r.null_pct, r.filled) for r in profile.null_profile(df).collect()}
    assert rows == {"a": (1, 33.33, 2), "b-c": (2, 66.67, 1)}
    assert profile.null_profile(df.limit(0)).first().null_pct is None
    assert [r.column_name for r in profile.columns_with_nulls(df.na.fill({"a": 0})).collect()] == ["b-c"]


def test_duplicate_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a")], "a int, b string")
    assert profile.duplicate_rows(df).first().duplicates == 2
    assert profile.duplicate_rows(df.limit(0)).first().duplicates == 0


def test_duplicate_rows_with_nulls_and_equal_prints(spark, monkeypatch):
    rows = [(None, 1), (1, None), (None, 1), (1, 1), (None, None), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "a int, `b c` int")
    assert profile.duplicate_rows(df).first().duplicates == 3
    monkeypatch.setattr(profile, "fingerprint", lambda df: [F.lit(1).alias("_print_a"), F.lit(2).alias("_print_b")])
    assert profile.duplicate_rows(df).first().duplicates == 3


def test_only_prints_are_shuffled_to_be_counted(spark):
    plan = profile.duplicate_rows(spark.range(9).selectExpr("id", "cast(id AS string) AS text"))._jdf.queryExecution().executedPlan().toString()
    counted = next(line for line in plan.splitlines() if "HashAggregate" in line and "partial_count" in line and "_row" not in line)
    assert "keys=[_print_a" in counted and "text" not in counted


def test_differing_rows_are_counted_as_often_as_they_occur(spark):
    kinds = "a long, b string, c decimal(6,2), d double"
    one = spark.createDataFrame([(1, "x", None, 0.0)] * 3 + [(2, None, None, None), (3, "", None, float("nan")), (4, "y", None, 1.0)], kinds)
    two = spark.createDataFrame([(1, "x", None, -0.0)] + [(2, None, None, None), (3, None, None, float("nan")), (4, "y", None, 1.0)] * 2, kinds)
    got = profile.differing_rows({"one": one, "two": two, "none": two.limit(0)}, {"a": ("one", "two"), "b": ("one", "one"), "c": ("two", "none")})
    both = [x.exceptAll(y).count() + y.exceptAll(x).count() for x, y in ((one, two), (one, one))]
    assert got.columns == ["a", "b", "c"] and tuple(got.first()) == (*both, 7) and both == [7, 0]
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2


def test_foreign_key_rules_differ_on_null(spark):
    child = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    check = checks.ForeignKeyCheck("t", "child", "c", "k", "parent", "k")
    report = lambda p: checks.report({"child": child, "parent": p}, [check]).first().violations
    assert report(parent) == 2
    assert report(with_null) == 1
    tests = [checks.ColumnTest("child", "k", "relationships", parent="parent", parent_column="k")]
    assert checks.run_column_tests({"child": child, "parent": parent}, tests).first().failures == 1


def test_unique_rules_differ_on_null(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (2,), (2,), (2,)], "k int")
    assert checks.report({"t": df}, [checks.UniqueCheck("t", "t", "c", "k")]).first().violations == 3
    assert checks.run_column_tests({"t": df}, [checks.ColumnTest("t", "k", "unique")]).first().failures == 1


def test_accepted_values_ignore_null_and_report_does_not(spark):
    df = spark.createDataFrame([("a",), ("x",), ("x",), ("y",), (None,)], "v string")
    tests = [checks.ColumnTest("t", "v", "accepted_values", values=("a",)), checks.ColumnTest("t", "v", "not_null")]
    assert [r.failures for r in checks.run_column_tests({"t": df}, tests).collect()] == [2, 1]
    row = checks.report({"t": df}, [checks.RowCheck("t", "t", "v", F.col("v").isin("a"), listed="v")]).first()
    assert (row.violations, row.detail) == (4, "invalid values: x, y")
    assert {(r.value, r.rows) for r in checks.unaccepted_values(df, "v", ["a"]).collect()} == {("x", 2), ("y", 1)}


def test_the_report_names_a_bounded_number_of_values(spark):
    df = spark.range(3000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("v"))
    check = checks.RowCheck("t", "t", "v", F.col("v") >= "v2990", listed="v", counted=None)
    row = checks.report({"t": df}, [check]).first()
    assert row.detail == "invalid values: v0000, v0001, v0002, v0003, v0004 and 2985 more" and row.violations == 2990
    assert checks.report({"t": df.limit(0)}, [check]).first().detail == "invalid values: "


def test_checks_of_one_table_share_a_reading(spark, tmp_path):
    spark.range(20).selectExpr("id AS k", "id % 3 AS p", "id % 5 AS v").write.parquet(f"{tmp_path}/child")
    spark.range(2).selectExpr("id AS p").write.parquet(f"{tmp_path}/parent")
    tables = {t: spark.read.parquet(f"{tmp_path}/{t}") for t in ("child", "parent")}
    tests = [
        checks.ColumnTest("child", "k", "unique"), checks.ColumnTest("child", "k", "not_null"), checks.ColumnTest("child", "v", "accepted_values", values=(0, 1)),
        checks.ColumnTest("child", "p", "relationships", parent="parent", parent_column="p"), checks.ColumnTest("parent", "p", "unique"),
    ]
    result = checks.run_column_tests(tables, tests)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Join" not in plan
    assert [r.failures for r in result.collect()] == [0, 0, 3, 6, 0]


def hot_orders(spark, rows=3000):
    """A third of the rows share one key, some have none, many are copies of each other."""
    picks = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i % 97}", i % 11) for i in range(rows)]
    return spark.createDataFrame(picks, "key string, x int").repartition(32)


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = dedup.keep_first(hot_orders(spark), ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
