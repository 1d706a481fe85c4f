from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import reconcile_deletes
from tidemark.operators.ranges import MAX_RANGES, cut, differing_ranges, digests, joined, reconcile_ranges


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ranges_are_cut_and_joined():
    assert cut((0, 9), 4) == [(0, 2), (3, 5), (6, 8), (9, 9)]
    assert cut((5, 5), 64) == [(5, 5)] and cut((-(2**63), 2**63 - 1), 2) == [(-(2**63), -1), (0, 2**63 - 1)]
    assert joined([(0, 1), (2, 3), (7, 8)], 9) == [(0, 3), (7, 8)]
    assert joined([(0, 0), (2, 2), (9, 9), (40, 41)], 2) == [(0, 9), (40, 41)] and joined([], 3) == []


def test_digests_do_not_depend_on_order_and_see_repeats(spark):
    keys = spark.range(1000).withColumnRenamed("id", "k")
    ranges = cut((0, 999), 8)
    assert rows_of(digests(keys, ["k"], ranges)) == rows_of(digests(keys.orderBy(F.desc("k")).repartition(7), ["k"], ranges))
    twice = lambda k: spark.createDataFrame([(k,), (k,)], "k long")
    one, two = (rows_of(digests(twice(k), ["k"], [(0, 9)])) for k in (3, 4))
    assert one != two and one[0][:3] == two[0][:3]  # only the sums tell pairs of equal rows apart


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("gone", ["k between 40000 and 40100 or k = 7", "k % 10 = 0", "false", "true"])
def test_equal_to_the_whole_comparison(spark, kind, gone):
    whole = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    target, source = (df.withColumn("k", F.col("k").cast(kind)) for df in (whole, whole.filter(f"not ({gone})").select("k")))
    source = source.unionByName(spark.range(500_000, 500_010).select(F.col("id").cast(kind).alias("k")))
    got = reconcile_ranges(target, source, ["k"], leaf_rows=100)
    assert sorted(got.columns) == sorted(reconcile_deletes(target, source, ["k"]).columns)
    assert rows_of(got.select("k", "v", "_op")) == rows_of(reconcile_deletes(target, source, ["k"]).select("k", "v", "_op"))


def test_equal_ranges_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(200_000).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(path)
    target = spark.read.parquet(path)
    target.filter("k not between 77000 and 77050 and k <> 150000").select(F.col("k").cast("int").alias("k")).write.parquet(path + "s")
    source = spark.read.parquet(path + "s")
    ranges = differing_ranges(target, source, ["k"], leaf_rows=100)
    assert 1 < len(ranges) <= MAX_RANGES and sum(high - low + 1 for low, high in ranges) < 2_000
    got = reconcile_ranges(target, source, ["k"], leaf_rows=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = [line.split("PushedFilters: [")[1] for line in plan.split("\n") if "PushedFilters: [" in line]
    assert len(pushed) == 2 and all("Or(And(GreaterThanOrEqual(k," in filters for filters in pushed)
    assert got.count() == 52
    assert differing_ranges(target, target.selectExpr("cast(k as int) k"), ["k"]) == []


def test_nulls_empties_and_repeats(spark):
    schema = "k long, part string, v int"
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "b", 3), (None, "a", 4), (2, None, 5), (3, "c", 6)], schema)
    source = spark.createDataFrame([(1, "a"), (None, "z"), (3, "c"), (3, "c")], "k long, part string")
    assert rows_of(reconcile_ranges(target, source, ["k", "part"]).select("k", "v", "_op")) == [(1, 2, "d"), (1, 3, "d")]
    assert reconcile_ranges(target.limit(0), source, ["k", "part"]).count() == 0
    assert reconcile_ranges(target, source.limit(0), ["k", "part"]).count() == 4
    with pytest.raises(TypeError):
        differing_ranges(target, source.withColumn("k", F.col("k").cast("string")), ["k"])
