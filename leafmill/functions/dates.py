"""Windows of dates, as rows."""

from __future__ import annotations

import bisect
import itertools
from datetime import date

from pyspark.sql import DataFrame, SparkSession


def year_windows(spark: SparkSession, first: str, last: str, newest_first: bool = False) -> DataFrame:
    """Calendar years from first to last as (start, end), both inclusive, the outer ones cut to the range."""
    return spark.sql(
        f"""select greatest(make_date(y, 1, 1), date'{first}') as start, least(make_date(y, 12, 31), date'{last}') as end
            from (select explode(sequence(year(date'{first}'), year(date'{last}'))) as y) order by y {'desc' if newest_first else 'asc'}"""
    )


def month_windows(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Months that begin in the range, newest first, as [start, end)."""
    return spark.sql(f"select m as start, add_months(m, 1) as end from (select explode(sequence(trunc(date'{first}', 'MM'), trunc(date'{last}', 'MM'), interval 1 month)) as m) order by m desc")


def days(spark: SparkSession, first: str, last: str, most: int = 3650) -> DataFrame:
    """Days newest first, at most ``most``."""
    return spark.sql(f"select explode(sequence(date'{last}', greatest(date'{first}', date_sub(date'{last}', {most - 1})), interval -1 day)) as day")


def quarters_begun(spark: SparkSession, first_year: int, today: str) -> DataFrame:
    """Quarters whose first day isn't after today."""
    return spark.sql(
        f"""select y as year, q as quarter, make_date(y, 3 * q - 2, 1) as start from (select explode(sequence({first_year}, year(date'{today}'))) as y)
            lateral view explode(array(1, 2, 3, 4)) t as q where make_date(y, 3 * q - 2, 1) <= date'{today}'"""
    )


def months(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Calendar months from first to last as (start, end), both inclusive, the outer ones cut to the range."""
    return spark.sql(f"select greatest(m, date'{first}') as start, least(last_day(m), date'{last}') as end from (select explode(sequence(trunc(date'{first}', 'MM'), date'{last}', interval 1 month)) as m)")


def years_half_open(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Calendar years as [start, end), the last one ending on the day after last."""
    return spark.sql(f"select greatest(make_date(y, 1, 1), date'{first}') as start, least(make_date(y + 1, 1, 1), date_add(date'{last}', 1)) as end from (select explode(sequence(year(date'{first}'), year(date'{last}'))) as y)")


def bisected(counts: DataFrame, share: float, limit: int = 100_000) -> DataFrame:
    """Windows [low, high] of days halved until none holds more than the share of all rows or it is one day. counts: (day, n), at most ``limit`` days (more are an error); the halves
    are found on sums up to each day, taken once. No days: no windows."""
    spark = counts.sparkSession
    rows = counts.orderBy("day").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} days")
    days, sums = [r["day"].toordinal() for r in rows], [0, *itertools.accumulate(r["n"] for r in rows)]
    within = lambda low, high: sums[bisect.bisect_right(days, high)] - sums[bisect.bisect_left(days, low)]
    most, todo, out = max(1, int(sums[-1] * share)), [(days[0], days[-1])] if days else [], []
    while todo:
        low, high = todo.pop()
        if within(low, high) <= most or low == high:
            out.append((date.fromordinal(low), date.fromordinal(high), within(low, high)))
        else:
            todo += [(low, low + (high - low) // 2), (low + (high - low) // 2 + 1, high)]
    return spark.createDataFrame(out, "low date, high date, n long")
