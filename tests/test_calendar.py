"""calendar_dim against DuckDB's own date functions, and the leap flag."""

from __future__ import annotations

import datetime as dt

import duckdb

from starweave.plans import calendar_dim

ORACLE = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS dateid,
       CAST(extract('year' FROM d) AS INTEGER) AS year,
       CAST(extract('quarter' FROM d) AS INTEGER) AS quarter,
       CAST(extract('month' FROM d) AS INTEGER) AS month,
       CAST(extract('week' FROM d) AS INTEGER) AS week,
       CAST(d AS DATE) AS date,
       lower(strftime(d, '%a')) AS week_day,
       CASE WHEN extract('day' FROM (d + INTERVAL 2 MONTH - INTERVAL 1 DAY)) = 29
            THEN 'leap' ELSE 'not leap' END AS leap
FROM generate_series(DATE '2010-01-01', DATE '2030-12-31', INTERVAL 1 DAY) AS t(d)
"""


def test_calendar_matches_duckdb(spark):
    got = sorted(tuple(r) for r in calendar_dim(spark, partitions=5).collect())
    want = sorted(duckdb.sql(ORACLE).fetchall())
    assert len(got) == 7670
    assert got == want


def test_calendar_schema(spark):
    assert calendar_dim(spark).dtypes == [
        ("dateid", "int"), ("year", "int"), ("quarter", "int"), ("month", "int"),
        ("week", "int"), ("date", "date"), ("week_day", "string"), ("leap", "string")]


def test_leap_flag_is_kept_as_computed(spark):
    cal = {r["date"]: r["leap"] for r in calendar_dim(spark).collect()}
    assert sum(v == "leap" for v in cal.values()) == 236
    assert cal[dt.date(2012, 1, 1)] == "leap"
    assert cal[dt.date(2011, 1, 1)] == "not leap"
    assert cal[dt.date(2023, 1, 30)] == "leap"
    assert cal[dt.date(2023, 7, 31)] == "leap"
    assert cal[dt.date(2012, 12, 31)] == "not leap"
    assert cal[dt.date(2012, 2, 29)] == "not leap"


def test_first_day_week_and_names(spark):
    first = calendar_dim(spark).orderBy("date").first()
    assert first["dateid"] == 20100101
    assert first["week"] == 53  # ISO week of 2010-01-01
    assert first["week_day"] == "fri"


def test_custom_range_is_inclusive(spark):
    assert calendar_dim(spark, "2020-02-27", "2020-03-01").count() == 4
