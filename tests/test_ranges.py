"""Uniqueness by sorted ranges: clean tables in key order are proved without a
shuffle, planted repeats are found in and across files."""

from __future__ import annotations

import datetime as dt
import os
import random
import tempfile
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starweave.operators import quality, surrogate_key
from starweave.operators.quality import (
    Check, repeated_keys, run_checks, unique_by_ranges, unique_violations,
)
from starweave.operators.ranges import RUNS, merged, overlaps, possible_repeats, sorted_runs


def _table(spark, files, kind="long"):
    """A table with one file for each list of keys, in that order."""
    path = os.path.join(tempfile.mkdtemp(prefix="starweave-ranges-"), "t")
    for keys in files:
        spark.createDataFrame([(k,) for k in keys], f"k {kind}").coalesce(1) \
            .write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _failures(df):
    return unique_by_ranges(df, "t", "k").first()["failures"]


def _twice(files):
    counts = Counter(k for f in files for k in f if k is not None)
    return sum(n > 1 for n in counts.values())


def test_a_clean_dimension_needs_no_shuffle(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="starweave-ranges-"), "dim")
    rows = spark.range(5000).selectExpr("concat('c', id * 7919 % 5000) AS name")
    surrogate_key(rows, "k", ["name"], partitions=6).write.parquet(path)
    dim = spark.read.parquet(path)
    runs = sorted_runs(dim, "k")
    assert "Exchange" not in _plan(runs)
    assert runs.where("not rising").count() == 0
    for column in ("k", "name"):  # the names are in the same order
        assert possible_repeats(dim, column) is None
    report = unique_by_ranges(dim, "dim", "k")
    assert report.first()["failures"] == 0 and "FileScan" not in _plan(report)


KINDS = {"long": lambda i: i, "int": lambda i: i, "string": lambda i: f"kä{i:05d}",
         "date": lambda i: dt.date(2000, 1, 1) + dt.timedelta(days=i)}


@pytest.mark.parametrize("kind", KINDS)
def test_planted_repeats_are_found_in_and_across_files(spark, kind):
    of = KINDS[kind]
    clean = [[of(i) for i in range(a, a + 300)] for a in (0, 300, 700)]
    planted = {
        "clean": clean,
        "in a file": [sorted([*clean[0], of(17), of(17)]), *clean[1:]],
        "at a border": [clean[0], [of(299), *clean[1]], clean[2]],
        "far away": [clean[0], clean[1], [*clean[2], of(5)]],
        "a whole file": [*clean, clean[1]],
        "nulls": [[None, None, *clean[0]], [*clean[1], None, of(2)], clean[2]],
        "overlap without repeats": [[of(i) for i in range(0, 600, 2)],
                                    [of(i) for i in range(1, 600, 2)]],
        "no order": [random.Random(3).sample(clean[0], 300), [*reversed(clean[1]), of(301)]],
    }
    for name, files in planted.items():
        df = _table(spark, files, kind)
        assert _failures(df) == repeated_keys(df, "k") == _twice(files), name
        assert _failures(df) == unique_violations(df, "k").count(), name


def test_empty_tables_and_other_types(spark):
    empty = spark.range(0).selectExpr("id AS k")
    assert possible_repeats(empty, "k") is None and _failures(empty) == 0
    nulls = spark.createDataFrame([(None,), (None,)], "k long")
    assert _failures(nulls) == 0
    for kind in ("double", "decimal(5,2)", "boolean"):
        df = spark.sql(f"SELECT CAST(v AS {kind}) AS k FROM VALUES (1), (1), (0), (NULL) AS t(v)")
        assert _failures(df) == 1, kind


def test_only_the_overlap_is_grouped_and_its_filter_reaches_the_scan(spark):
    files = [list(range(0, 1000)), list(range(1000, 2000)), [1500, 1501, 9000]]
    left = possible_repeats(_table(spark, files), "k")
    assert left.count() == 502  # 1500 to 1999, and both in the third file
    assert "GreaterThanOrEqual(k,1500)" in _plan(left) and "LessThanOrEqual(k,1999)" in _plan(left)


def test_tasks_in_no_order_send_one_row(spark):
    keys = random.Random(1).sample(range(10_000), 5000)
    runs = sorted_runs(spark.createDataFrame([(k,) for k in keys], "k long").coalesce(1), "k")
    assert [tuple(r) for r in runs.collect()] == [(min(keys), max(keys), False)]
    few = [k for i in range(RUNS) for k in range(10 * i, 10 * i + 20)]
    runs = sorted_runs(spark.createDataFrame([(k,) for k in few], "k long").coalesce(1), "k")
    assert [tuple(r) for r in runs.collect()] == [
        (10 * i, 10 * i + 19, True) for i in range(RUNS)]


def test_runs_go_on_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(0, 1000, 1, 1).selectExpr("id AS k")
        assert [tuple(r) for r in sorted_runs(df, "k").collect()] == [(0, 999, True)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=12), max_size=12),
       st.integers(1, 4))
def test_every_repeated_key_lies_in_an_interval(parts, most):
    runs, counts = [], Counter()
    for keys in parts:
        rising = all(a < b for a, b in zip(keys, keys[1:]))
        runs.append((keys[0], keys[-1], True) if rising else (min(keys), max(keys), False))
        counts.update(keys)
    intervals = merged(overlaps(runs), most)
    assert len(intervals) <= most
    assert all(a[1] < b[0] for a, b in zip(intervals, intervals[1:]))
    for key, n in counts.items():
        assert n == 1 or any(lo <= key <= hi for lo, hi in intervals)


def test_declared_tests_in_key_order_give_the_same_report(spark):
    files = [[1, 2, 3, None], [3, 4, 5]]
    relations = {"t": _table(spark, files)}
    checks = [Check("unique", "t", "k"), Check("not_null", "t", "k"),
              Check("relationships", "t", "k", to="t", field="k")]
    want = [tuple(r) for r in run_checks(relations, checks).collect()]
    got = [tuple(r) for r in run_checks(relations, checks, in_key_order=True).collect()]
    assert sorted(got) == sorted(want) and [r[3] for r in got] == [1, 1, 0]


def test_whole_numbers_in_overlaps_still_meet_as_bitmaps(spark, monkeypatch):
    plans = []
    real = quality.stored
    monkeypatch.setattr(quality, "stored", lambda df: plans.append(_plan(df)) or real(df))
    assert repeated_keys(_table(spark, [[1, 2, 3], [4, 5, 6]]), "k") == 0 and not plans
    assert repeated_keys(_table(spark, [[1, 2, 3], [3, 4, 5]]), "k") == 1
    assert "bitmap_construct_agg" in plans[0]
