"""Lookup joins broadcast only what was measured to fit."""

from __future__ import annotations

import pytest

from starweave.operators.joins import (
    fits_broadcast,
    fitting_together,
    hot_keys,
    lookup_join,
    measure,
    salted_join,
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_measure_counts_rows_and_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "k long, s string")
    size = measure(df)
    assert size.rows == 2
    assert size.bytes == (8 + 3 + 8) + (8 + 0 + 8)


def test_small_dimension_is_broadcast(spark):
    big = spark.range(10000).selectExpr("id % 50 AS k", "id AS v")
    dim = spark.range(50).selectExpr("id AS k", "id * 2 AS w")
    assert fits_broadcast(dim)
    out = lookup_join(big, dim, ["k"], "left")
    assert "BroadcastHashJoin" in _plan(out)
    assert out.count() == 10000


def test_dimension_over_the_bound_is_merge_joined(spark):
    big = spark.range(10000).selectExpr("id % 50 AS k", "id AS v")
    dim = spark.range(50).selectExpr("id AS k", "id * 2 AS w")
    out = lookup_join(big, dim, ["k"], "left", max_bytes=10)
    plan = _plan(out)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert out.count() == 10000


def _skewed(spark):
    # Key 7 holds a third of the rows; NULL keys must survive a left join.
    rows = [(7, i) for i in range(3000)] + [(i % 500, i) for i in range(6000)] \
        + [(None, i) for i in range(50)]
    left = spark.createDataFrame(rows, "k long, v long")
    dim = spark.range(500).selectExpr("id AS k", "concat('name-', id) AS w") \
        .union(spark.createDataFrame([(7, "second row for seven")], "k long, w string"))
    return left, dim


def _hash(spark, k: int) -> int:
    return spark.sql(f"SELECT xxhash64(CAST({k} AS BIGINT)) AS h").first()["h"]


def test_hot_keys_of_all_lookups_in_one_pass(spark):
    left, _ = _skewed(spark)
    # 3 holds two thirds of the second column and 5 of the pairs' first halves a few rows.
    left = left.selectExpr("k", "CASE WHEN v % 3 = 0 THEN v ELSE 3 END AS other")
    group = "one pass"
    spark.sparkContext.setJobGroup(group, group)
    found = hot_keys(left, [["k"], ["other"], ["k", "other"]], share=0.05)
    scans = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[0] == [_hash(spark, 7)] and found[1] == [_hash(spark, 3)]
    assert len(found[2]) == 1  # (7, 3); rows with a NULL key do not count
    assert scans <= 2  # one aggregate, in the stages of adaptive execution
    assert hot_keys(spark.range(1000).selectExpr("id AS k"), [["k"]], share=0.05) == [[]]
    assert hot_keys(left.limit(0), [["k"]]) == [[]] and hot_keys(left, []) == []


@pytest.mark.parametrize("share", [0.2, 0.01, 0.002])
def test_planted_hot_keys_are_always_found(spark, share):
    # Many distinct keys around a key that holds just the share.
    n = 40_000
    hot = int(n * share)
    rows = spark.range(0, n, 1, 5).selectExpr(f"CASE WHEN id % {n // hot} = 0 THEN -1 ELSE id END AS k")
    assert _hash(spark, -1) in hot_keys(rows, [["k"]], share)[0]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_and_null_keys_are_salted_in_one_merge_join(spark, how):
    left, dim = _skewed(spark)
    want = sorted(map(tuple, left.join(dim, ["k"], how).collect()), key=str)
    out = lookup_join(left, dim, ["k"], how, max_bytes=2000, hot_share=0.05,
                      hot_from=left.select("k"), salts=5)
    plan = _plan(out)
    assert plan.count("SortMergeJoin") == 1
    assert sorted(map(tuple, out.collect()), key=str) == want
    assert out.columns == left.join(dim, ["k"], how).columns


def test_salts_deal_out_hot_and_null_rows(spark):
    left, dim = _skewed(spark)
    null_rows = left.where("k is null").unionAll(left.where("k = 7"))
    out = salted_join(null_rows, dim, ["k"], "left", [_hash(spark, 7)], 8)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(xxhash64" in plan
    dealt = null_rows.selectExpr("pmod(xxhash64(k, v), 8) AS s").groupBy("s").count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 600


def test_dimensions_share_one_broadcast_bound(spark):
    dims = [spark.range(n).selectExpr("id AS k", "id AS w") for n in (1000, 10, 100)]
    assert fitting_together(dims, 16 * 1110) == [True, True, True]
    assert fitting_together(dims, 16 * 1109) == [False, True, True]
    assert fitting_together(dims, 16 * 50) == [False, True, False]


def test_bytes_decide_what_fits(spark):
    dim = spark.range(10000).selectExpr("id AS k", "repeat('x', 100) AS w")
    assert fits_broadcast(dim, 10_000 * (8 + 100 + 8))
    assert not fits_broadcast(dim, 10_000 * (8 + 100 + 8) - 1)


def test_spread_only_touches_under_split_scans(spark):
    from starweave.operators.partitioning import spread
    one = spark.range(0, 1000, 1, 1)
    assert spread(one, 6).rdd.getNumPartitions() == 6
    many = spark.range(0, 1000, 1, 12)
    assert spread(many, 6) is many
    assert spread(one, None) is one
