"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names shown in the calendar dimension.
YEAR_WORD = "Год"
MONTH_NAMES = (
    "Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
    "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь",
)
DAY_NAMES = (
    "Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье",
)


def week_number(day: Column) -> Column:
    """Monday-based week 0..53; week 1 is the first with four days in the year."""
    offset = F.dayofyear(day) - 1
    new_year = F.pmod(F.weekday(day) - offset, F.lit(7))
    whole_weeks = F.floor((offset + new_year) / 7).cast("int")
    return whole_weeks + F.when(new_year <= 3, 1).otherwise(0)


def _name(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def calendar_columns(day: Column) -> dict[str, Column]:
    """All calendar attributes in table order, keyed by column name."""
    year, month, quarter = F.year(day), F.month(day), F.quarter(day)
    year_text = year.cast("string")
    quarter_name = F.concat(F.lit("Q"), quarter.cast("string"))
    week = week_number(day)
    iso_day = F.weekday(day) + 1
    leap = (year % 400 == 0) | ((year % 4 == 0) & (year % 100 != 0))
    return {
        "date_sk": year * 10000 + month * 100 + F.dayofmonth(day),
        "full_date": day,
        "year": year,
        "year_name": F.concat(F.lit(YEAR_WORD + " "), year_text),
        "is_leap_year": leap.cast("int"),
        "quarter": quarter,
        "quarter_name": quarter_name,
        "year_quarter": F.concat_ws("-", year_text, quarter_name),
        "month": month,
        "month_name": _name(MONTH_NAMES, month),
        "year_month": F.date_format(day, "yyyy-MM"),
        "days_in_month": F.dayofmonth(F.last_day(day)),
        "week_of_year": week,
        "week_of_month": week - week_number(F.trunc(day, "month")) + 1,
        "year_week": F.concat(year_text, F.lit("-W"), F.lpad(week.cast("string"), 2, "0")),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "day_of_week": iso_day,
        "day_name": _name(DAY_NAMES, iso_day),
        "is_weekend": (iso_day >= 6).cast("int"),
        "is_holiday": F.lit(0),
    }
