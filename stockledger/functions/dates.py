"""Date expressions shared by the ledger and the KPIs (all JVM-side)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Period


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_years(c: str | Column, period: Period) -> Column:
    """``year(c) IN period.years`` as a range on the raw column.

    A plain comparison on the column reaches the Parquet reader as a
    pushed filter, where ``year(c)`` would not. Years need not be
    contiguous; a range per run of consecutive years keeps it exact.
    """
    c = as_col(c)
    years = sorted(set(period.years))
    runs: list[tuple[int, int]] = []
    for y in years:
        if runs and runs[-1][1] == y - 1:
            runs[-1] = (runs[-1][0], y)
        else:
            runs.append((y, y))
    cond = None
    for lo, hi in runs:
        part = (c >= F.lit(dt.date(lo, 1, 1))) & (c < F.lit(dt.date(hi + 1, 1, 1)))
        cond = part if cond is None else (cond | part)
    return cond


def year_of(c: str | Column) -> Column:
    return F.year(as_col(c)).cast("int")


def year_start(y: Column) -> Column:
    return F.make_date(y, F.lit(1), F.lit(1))


def year_end(y: Column) -> Column:
    return F.make_date(y, F.lit(12), F.lit(31))


def overlap_days(start: str | Column, end: str | Column, year: Column) -> Column:
    """Days of the closed range [start, end] that fall in calendar ``year``."""
    lo = F.greatest(as_col(start), year_start(year))
    hi = F.least(as_col(end), year_end(year))
    return F.greatest(F.datediff(hi, lo) + 1, F.lit(0)).cast("long")


def days_in_year(year: Column, days_per_year: int | str) -> Column:
    """Divisor of the mean stock: a fixed count (365 by default) or the calendar."""
    if days_per_year == "calendar":
        return F.datediff(year_start(year + 1), year_start(year))
    return F.lit(int(days_per_year))


def day_series(start: str | Column, end: str | Column) -> Column:
    """Every day from ``start`` to ``end``, both included.

    Callers guarantee start <= end; a descending two-argument sequence
    would silently count backwards.
    """
    return F.explode(F.sequence(as_col(start), as_col(end)))
