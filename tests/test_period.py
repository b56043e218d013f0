"""Period parameters and their command-line parsing (no Spark needed)."""

import argparse
import datetime as dt

import pytest

from stockledger.__main__ import _period
from stockledger.config import ADAPTER_PERIOD, RETAIL_PERIOD, Period


def _args(**kw):
    base = dict(driver_tables=None, opening=None, closing=None, years=None, calendar_days=False)
    base.update(kw)
    return argparse.Namespace(**base)


def test_defaults_follow_the_inputs():
    assert _period(_args()) == RETAIL_PERIOD
    assert _period(_args(driver_tables="/x")) == ADAPTER_PERIOD


def test_explicit_period_and_years():
    p = _period(_args(opening="2017-01-01", closing="2018-12-31"))
    assert p.years == (2017, 2018) and p.days_per_year == 365
    p = _period(_args(opening="2017-01-01", closing="2019-06-30", years="2017,2019", calendar_days=True))
    assert p.years == (2017, 2019) and p.days_per_year == "calendar"


def test_period_checks_its_bounds():
    with pytest.raises(ValueError):
        Period(dt.date(2020, 1, 1), dt.date(2019, 12, 31))
    p = Period(dt.date(2019, 3, 1), dt.date(2020, 2, 1))
    assert p.years == (2019, 2020)
