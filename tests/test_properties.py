"""Seeded random movements: Spark ledger == brute force, and invariances."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stockledger.config import Period
from stockledger.operators import ledger

from fixtures import facts_df, products_df

P = Period(dt.date(2019, 1, 1), dt.date(2019, 3, 31), (2019,))
PRODUCTS = [(1, 1, "A", 1, 1), (2, 1, "A", 1, 1), (3, 2, "B", 1, 1), (4, None, "B", 1, 1)]
ROOT = {p[0]: p[1] for p in PRODUCTS}
DAY = dt.timedelta(days=1)

moves = st.lists(
    st.tuples(
        st.integers(1, 2),  # store
        st.integers(1, 5),  # product; 5 is unknown
        st.dates(dt.date(2018, 12, 20), dt.date(2019, 4, 10)),
        st.integers(-6, 9),
    ),
    min_size=0,
    max_size=25,
)


def brute(rows):
    by_key = defaultdict(list)
    for store, pid, day, q in rows:
        if ROOT.get(pid) is not None:
            by_key[(ROOT[pid], store)].append((day, q))
    out = set()
    for (root, store), mv in by_key.items():
        days = sorted({max(d, P.opening) for d, _ in mv if d <= P.closing})
        for i, day in enumerate(days):
            bal = sum(q for d, q in mv if d <= day)
            if bal > 0:
                end = days[i + 1] - DAY if i + 1 < len(days) else P.closing
                out.add((root, store, day, end, bal))
    return out


def spark_intervals(spark, rows):
    mv = facts_df(spark, [(s, p, d.isoformat(), q) for s, p, d, q in rows])
    led = ledger.stock_ledger(mv, products_df(spark, PRODUCTS), P, master_fits=True)
    return ledger.interval_stock(led, P)


SETTINGS = dict(
    max_examples=12, deadline=None, derandomize=True, database=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@settings(**SETTINGS)
@given(rows=moves)
def test_intervals_equal_brute_force(spark, rows):
    iv = spark_intervals(spark, rows)
    got = {tuple(r) for r in iv.collect()}
    assert got == brute(rows)
    # intervals of a key never overlap and never leave the period
    by_key = defaultdict(list)
    for r, s, a, b, _ in got:
        assert P.opening <= a <= b <= P.closing
        by_key[(r, s)].append((a, b))
    for spans in by_key.values():
        spans.sort()
        assert all(spans[i][1] < spans[i + 1][0] for i in range(len(spans) - 1))
    # daily rows = sum of spans
    n_days = sum((b - a).days + 1 for _, _, a, b, _ in got)
    assert ledger.daily_stock(iv).count() == n_days


@settings(**SETTINGS)
@given(rows=moves, seed=st.integers(0, 10_000), cut=st.integers(-3, 3))
def test_order_and_split_invariance(spark, rows, seed, cut):
    import random

    base = {tuple(r) for r in spark_intervals(spark, rows).collect()}
    shuffled = list(rows)
    random.Random(seed).shuffle(shuffled)
    split = []
    for s, p, d, q in shuffled[:1]:
        split += [(s, p, d, cut), (s, p, d, q - cut)]
    split += shuffled[1:]
    assert {tuple(r) for r in spark_intervals(spark, split).collect()} == base


points = st.lists(
    st.tuples(st.sampled_from([1, 2]), st.integers(1, 2), st.dates(dt.date(2018, 12, 1), dt.date(2019, 5, 1))),
    min_size=1,
    max_size=8,
)


@settings(**SETTINGS)
@given(rows=moves, pts=points)
def test_stock_as_of_equals_definition(spark, rows, pts):
    """Balance at a point = sum of quantities dated on or before it (null if none)."""
    mv = facts_df(spark, [(s, p, d.isoformat(), q) for s, p, d, q in rows])
    rooted = ledger.attach_root(mv, products_df(spark, PRODUCTS), master_fits=True)
    pdf = spark.createDataFrame(
        [(r, s, d) for r, s, d in pts], "ProductRootCode long, StoreId long, AsOf date"
    )
    got = sorted((r.ProductRootCode, r.StoreId, r.AsOf, r.Balance) for r in ledger.stock_as_of(rooted, pdf).collect())
    want = []
    for r, s, d in pts:
        qs = [q for st_, pid, day, q in rows if ROOT.get(pid) == r and st_ == s and day <= d]
        want.append((r, s, d, sum(qs) if qs else None))
    assert got == sorted(want)
