"""Column expressions in stockledger.functions."""

import datetime as dt

from pyspark.sql import functions as F

from stockledger.config import Period
from stockledger.functions.dates import days_in_year, in_years, overlap_days
from stockledger.functions.labels import year_entity_label


def d(s):
    return dt.date.fromisoformat(s)


def test_in_years_handles_gaps_and_pushes_ranges(spark):
    p = Period(d("2017-01-01"), d("2020-12-31"), (2017, 2019, 2020))
    df = spark.createDataFrame(
        [(d(x),) for x in ("2016-12-31", "2017-06-01", "2018-03-03", "2019-01-01", "2020-12-31", "2021-01-01")],
        "Date date",
    )
    got = [r.Date.isoformat() for r in df.filter(in_years("Date", p)).orderBy("Date").collect()]
    assert got == ["2017-06-01", "2019-01-01", "2020-12-31"]
    # plain comparisons on the column, no function wrapped around it
    expr = str(in_years("Date", p)._jc.toString())
    assert "year(" not in expr.lower()


def test_overlap_days_across_year_ends_and_leap_years(spark):
    rows = [
        ("2019-12-30", "2020-01-02", 2019, 2),
        ("2019-12-30", "2020-01-02", 2020, 2),
        ("2020-01-01", "2020-12-31", 2020, 366),
        ("2019-03-01", "2019-03-01", 2019, 1),
        ("2019-03-01", "2019-03-05", 2020, 0),
    ]
    df = spark.createDataFrame([(d(a), d(b), y) for a, b, y, _ in rows], "s date, e date, y int")
    got = [r[0] for r in df.select(overlap_days("s", "e", F.col("y"))).collect()]
    assert got == [n for *_, n in rows]


def test_days_in_year(spark):
    df = spark.createDataFrame([(2019,), (2020,), (2100,)], "y int")
    cal = [r[0] for r in df.select(days_in_year(F.col("y"), "calendar")).collect()]
    fixed = [r[0] for r in df.select(days_in_year(F.col("y"), 365)).collect()]
    assert cal == [365, 366, 365] and fixed == [365, 365, 365]


def test_label_null_entity_gives_null(spark):
    df = spark.createDataFrame([(2019, "A"), (2020, None)], "Anio int, Family string")
    got = [r[0] for r in df.select(year_entity_label("Anio", "Family")).collect()]
    assert got == ["2019 - A", None]
