"""Dates, periods and windows."""

from datetime import date, datetime, timedelta, timezone

import pytest
from murmurio.functions import temporal as D
from pyspark.sql import functions as F


@pytest.mark.parametrize("text, expected", [
    (None, None), ("", None), ("x", None), ("2026-13-01", None), (" 2026-08-15", None),
    ("2026-08", None), ("2026-08-15", "2026-08-15 00:00:00"),
    ("2026-08-15T10:00:00Z", "2026-08-15 10:00:00"), ("2026-08-15T10:00", "2026-08-15 10:00:00"),
    ("2026-08-15T10:00:00+03:00", "2026-08-15 07:00:00"),
    ("2026-08-15T10:00:00-0330", "2026-08-15 13:30:00"),
    ("2026-08-15 10:00:00.25", "2026-08-15 10:00:00.25"),
    ("2026-08-15T10:00-03", "2026-08-15 13:00:00"),
])
def test_parse_iso(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(D.parse_iso("t").cast("string")).first()[0] == expected


def test_parse_epoch_and_objectid(spark):
    df = spark.createDataFrame([("60", "0000003c" + "0" * 16), ("x", "zz"), (None, None)],
                               "e string, o string")
    got = [tuple(r) for r in df.select(F.unix_timestamp(D.parse_epoch("e")),
                                       F.unix_timestamp(D.objectid_time("o"))).collect()]
    assert got == [(60, 60), (None, None), (None, None)]


@pytest.mark.parametrize("days", [1, 5, 7])
def test_period_grid(spark, days):
    epoch = date(2026, 7, 27)
    span = [epoch + timedelta(days=i) for i in range(-30, 30)]
    df = spark.createDataFrame([(d,) for d in span], "d date")
    got = df.select("d", D.period_start("d", days, "2026-07-27"),
                    D.last_closed_period("d", days, "2026-07-27"),
                    D.is_period_boundary("d", days, "2026-07-27")).collect()
    for day, start, closed, boundary in got:
        assert start == epoch + timedelta(days=(day - epoch).days // days * days)
        assert start <= day < start + timedelta(days=days)
        assert closed == start - timedelta(days=days)
        assert boundary == (day == start)


def month_cuts(start, end):
    out, cursor = [], start
    while cursor < end:
        following = (cursor.replace(day=28) + timedelta(days=4)).replace(day=1)
        out.append((cursor, min(following, end)))
        cursor = min(following, end)
    return [tuple(int(datetime(d.year, d.month, d.day, tzinfo=timezone.utc).timestamp())
                  for d in pair) for pair in out]


@pytest.mark.parametrize("a, b", [("2026-01-15", "2026-03-01"), ("2026-01-01", "2026-01-02"),
                                  ("2025-11-30", "2026-02-02"), ("2026-02-01", "2026-02-01"),
                                  ("2026-02-02", "2026-02-01")])
def test_month_windows(spark, a, b):
    df = spark.sql("select 1").select(D.month_windows(F.lit(a), F.lit(b)))
    got = [tuple(w) for w in df.first()[0]]
    assert got == month_cuts(date.fromisoformat(a), date.fromisoformat(b))


def test_day_modes(spark):
    df = spark.createDataFrame([("2026-01-01 23:59:59",), ("2026-01-01 23:59:59.5",),
                                ("2026-01-02 00:00:00",)], "t string").select(
        F.col("t").cast("timestamp"))
    assert df.where(D.on_day("t", "2026-01-01")).count() == 2
    assert df.where(D.on_day("t", "2026-01-01", "whole_seconds")).count() == 1


def test_local_day(spark):
    df = spark.createDataFrame([("2026-01-02 02:59:59",)], "t string").select(
        F.col("t").cast("timestamp"))
    assert df.select(D.local_day("t")).first()[0] == date(2026, 1, 1)


def test_slices(spark):
    df = spark.createDataFrame([("2026-01-01 00:00:00",), ("2026-01-01 02:00:00",),
                                ("2026-01-02 02:00:00",)], "t string").select(
        F.col("t").cast("timestamp"))
    due = df.where(D.slice_is_due("t", F.lit(date(2026, 1, 2)))).count()
    assert due == 2
