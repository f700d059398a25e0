from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from aislewise.functions import periods as P
from aislewise.operators.storerank import select_period


def month_weeks(first):
    """Weeks of a month by walking its days: Wednesday opens a week, week 1 reaches back to one."""
    weeks, week, day = {}, 1, first
    back = first
    while back.weekday() != 2:
        back -= timedelta(1)
        weeks.setdefault(1, []).append(back)
    while day.month == first.month:
        weeks.setdefault(week, []).append(day)
        if day.weekday() == 1:
            week += 1
        day += timedelta(1)
    return weeks


def test_weeks_of_four_years(spark):
    days = [date(2013, 12, 1) + timedelta(n) for n in range(1500)]
    df = spark.createDataFrame([(d,) for d in days], "dt date")
    got = {(r.dt, r.month, r.week) for r in df.select("dt", F.inline(P.month_weeks(F.col("dt")))).collect()}
    expected = set()
    for first in sorted({d.replace(day=1) for d in days}) + [days[-1].replace(day=1) + timedelta(40)]:
        first = first.replace(day=1)
        for week, members in month_weeks(first).items():
            expected |= {(d, first, week) for d in members if days[0] <= d <= days[-1]}
    assert got == expected


@pytest.mark.parametrize("mode,start", [
    ("day", date(2014, 5, 2)), ("week", date(2014, 4, 30)), ("month", date(2014, 5, 1)), ("season", date(2014, 4, 1)),
])
def test_select_period(spark, mode, start):
    as_of = date(2014, 5, 2)
    days = [date(2014, 1, 1) + timedelta(n) for n in range(200)]
    df = spark.createDataFrame([(d,) for d in days], "dt date")
    got = sorted(r.dt for r in select_period(df, as_of, mode).collect())
    assert got == [d for d in days if start <= d <= as_of]


def test_select_period_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(40).select(F.expr("date_add(date'2014-05-01', CAST(id AS INT))").alias("dt"), "id")
    days.write.partitionBy("dt").parquet(path)
    plan = select_period(spark.read.parquet(path), date(2014, 5, 20), "week")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(dt" in plan.toString()
    assert ">= 2014-05-14" in plan.toString()


def test_unknown_mode():
    with pytest.raises(ValueError):
        P.period_start(None, "year")


def test_run_date():
    assert P.run_date("/out/2014/10/06") == "20141006"
    assert P.run_date("/out/x", "20141006") == "20141006"
    with pytest.raises(ValueError):
        P.run_date("/out/x", "yesterday")
