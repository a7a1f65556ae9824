from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmart.functions import calendar, keys, moments, numbers, text

AS_OF = "2026-03-08 12:00:00"


def apply(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string").select("i", expression(F.col("x")).alias("y"))
    return [r.y for r in sorted(df.collect(), key=lambda r: r.i)]


def test_text_defaults_and_blank_before_trim(spark):
    values = [None, "", "   ", " Ab ", "ЁЖ"]
    assert apply(spark, values, lambda x: text.tidy(x)) == ["unknown", "unknown", "", "ab", "ёж"]
    assert apply(spark, values, lambda x: text.tidy(x, "", lower=False)) == ["", "", "", "Ab", "ЁЖ"]
    assert apply(spark, values, lambda x: text.tidy(x, strict=True)) == [
        "unknown", "unknown", "unknown", "ab", "ёж"]


def test_group_and_list_characters(spark):
    values = ["🥩 Мясо, рыба, яйца и бобовые", "A-1_b!", "x.y, z"]
    assert apply(spark, values, lambda x: text.tidy(x, drop=text.GROUP_DROP)) == [
        "мясо рыба яйца и бобовые", "a-1b", "xy z"]
    assert apply(spark, values, lambda x: text.tidy(x, drop=text.LIST_DROP)) == [
        "мясо, рыба, яйца и бобовые", "a-1b", "x.y, z"]


def test_full_name_defaults_each_part(spark):
    df = spark.createDataFrame([(" Ann ", ""), ("   ", "Lee")], "a string, b string")
    got = [r[0] for r in df.select(text.full_name(F.col("a"), F.col("b"))).collect()]
    assert got == ["ann unknown", " lee"]


def test_flags(spark):
    values = [None, "", "True", " yes ", "1", "YES", "no", "0", "truе"]
    assert apply(spark, values, lambda x: text.truthy(x)) == [0, 0, 1, 1, 1, 1, 0, 0, 0]


def test_doubles(spark):
    values = [None, "", "   ", " 1.5 ", "nan", "inf", "-1", "-0", "0", "1e3", "1d", "0x1p3", "abc", ".5", "5."]
    assert apply(spark, values, lambda x: numbers.non_negative_double(x)) == [
        None, None, None, 1.5, None, None, None, -0.0, 0.0, 1000.0, None, None, None, 0.5, 5.0]
    assert apply(spark, ["90", "90.1", "-90", "-90.01", "NaN"], lambda x: numbers.bounded_double(x, -90, 90)) == [
        90.0, None, -90.0, None, None]


def test_decimals_cut_surplus_digits(spark):
    values = ["1.005", "1.009", "-1", "abc", "", None, "1e3", "-0.00", "99999999999"]
    got = apply(spark, values, lambda x: numbers.fixed_decimal(x, 10, 2))
    assert got == [Decimal("1.00"), Decimal("1.00"), None, None, None, None, Decimal("1000.00"),
                   Decimal("0.00"), None]
    rounded = apply(spark, ["1.005"], lambda x: numbers.fixed_decimal(x, 10, 2, rounding=True))
    assert rounded == [Decimal("1.01")]
    assert apply(spark, ["-1", "2.5"], lambda x: numbers.amount_or_zero(x)) == [Decimal("0.00"), Decimal("2.50")]
    assert apply(spark, ["0", "0.0004", "abc", "2.5", "-3"], lambda x: numbers.quantity_or_one(x)) == [
        Decimal("1.000"), Decimal("1.000"), Decimal("1.000"), Decimal("2.500"), Decimal("1.000")]


def test_small_ints(spark):
    values = ["0", "1", "65535", "65536", "70000", "1.5", "abc", "", None, " 7 ", "-1"]
    assert apply(spark, values, lambda x: numbers.small_positive_int(x)) == [
        None, 1, 65535, None, None, None, None, None, None, 7, None]


def test_ratios(spark):
    row = spark.sql("select 0 as a, 0 as b").select(
        numbers.percent(F.col("a"), F.col("b")).alias("p"),
        numbers.share(F.lit(None).cast("int"), F.lit(None).cast("int")).alias("s"),
    ).first()
    assert row.p is None and row.s == 0.0


def test_dates(spark):
    values = ["2026", "2026-3-8", "1899-12-31", "1900-01-01", "2026-03-08", "2026-03-09", "abc", "", None,
              "2025-02-30", "2020-01-01T10:00:00.5"]
    assert apply(spark, values, lambda x: moments.day_until(x, AS_OF, "1900-01-01")) == [
        None, None, None, date(1900, 1, 1), date(2026, 3, 8), None, None, None, None, None,
        date(2020, 1, 1)]
    assert apply(spark, ["1899-12-31"], lambda x: moments.day_until(x, AS_OF)) == [date(1899, 12, 31)]


def test_times(spark):
    values = ["2026-03-08T10:11:12.123456", "2026-03-08T13:00:00", "soon", "", None]
    now = datetime(2026, 3, 8, 12)
    assert apply(spark, values, lambda x: moments.moment_or(x, AS_OF)) == [
        datetime(2026, 3, 8, 10, 11, 12, 123456), now, now, now, now]
    assert apply(spark, values, lambda x: moments.seconds_moment(x))[:3] == [
        datetime(2026, 3, 8, 10, 11, 12), datetime(2026, 3, 8, 13), None]


def test_offsets_become_moscow_wall_clock(spark):
    values = ["2026-03-08T10:00:00Z", "2026-03-08T10:00:00.000001+03:00", "2026-03-08T10:00:00-05:30",
              "2026-03-08T10:00:00", "bad"]
    assert apply(spark, values, lambda x: moments.fixed_offset_clock(x)) == [
        datetime(2026, 3, 8, 13), datetime(2026, 3, 8, 10, 0, 0, 1),
        datetime(2026, 3, 8, 18, 30), datetime(2026, 3, 8, 10), None]


@pytest.mark.parametrize("past_only,expected", [(False, [True, True, False, True]),
                                                (True, [True, True, False, False])])
def test_day_window_edges(spark, past_only, expected):
    values = ["2026-03-08 00:00:00", "2026-03-01 23:59:59", "2026-02-28 23:59:59", "2026-03-09 00:00:00"]
    got = apply(spark, values, lambda x: moments.within_days(AS_OF, x.cast("timestamp_ntz"), 7, past_only))
    assert got == expected


def test_keys_are_stable_and_null_aware(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", "")], "a string, b string")
    for name, hasher in keys.HASHERS.items():
        got = [r[0] for r in df.select(hasher(F.col("a"), F.col("b"))).collect()]
        assert got[0] != got[1], name
    assert df.select(keys.key_or_null(F.col("b") != "", F.col("a")).alias("k")).collect()[1].k is None
    big = spark.range(200_000).select(keys.key64(F.col("id").cast("string")).alias("k"))
    assert big.distinct().count() == 200_000


def _week(day: date) -> int:
    first = date(day.year, 1, 1)
    monday = first - timedelta(days=first.weekday())
    if first.weekday() > 3:
        monday += timedelta(days=7)
    return (day - monday).days // 7 + 1


def test_calendar_every_day_2015_to_2031(spark):
    days = [date(2015, 1, 1) + timedelta(days=i) for i in range(17 * 365 + 5)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(*[v.alias(k) for k, v in calendar.calendar_columns(F.col("d")).items()]).collect()
    assert len(rows) == len(days)
    for row in rows:
        d = row.full_date
        leap = d.year % 4 == 0 and (d.year % 100 != 0 or d.year % 400 == 0)
        assert row.date_sk == int(f"{d:%Y%m%d}")
        assert row.is_leap_year == int(leap)
        assert row.week_of_year == _week(d), d
        assert row.week_of_month == _week(d) - _week(d.replace(day=1)) + 1
        assert row.year_week == f"{d.year}-W{_week(d):02d}"
        assert row.day_of_week == d.isoweekday()
        assert row.is_weekend == int(d.isoweekday() >= 6)
        assert row.day_of_year == d.timetuple().tm_yday
        assert row.quarter_name == f"Q{(d.month + 2) // 3}"
        assert row.month_name == calendar.MONTH_NAMES[d.month - 1]
        assert row.day_name == calendar.DAY_NAMES[d.isoweekday() - 1]
        assert row.days_in_month == (d.replace(day=28) + timedelta(days=4)).replace(day=1).toordinal() - d.replace(day=1).toordinal()
