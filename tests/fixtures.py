"""Hand-made inputs of FIXTURES.md §3 (M1-M3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from stockledger import schema as S


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def money(v):
    return None if v is None else Decimal(v).quantize(Decimal("0.01"))


def products_df(spark, rows):
    """rows: (id, root, family, retail, supplier)."""
    return spark.createDataFrame(
        [(i, r, f, money(rp), money(sp)) for i, r, f, rp, sp in rows], S.PRODUCTS
    )


def facts_df(spark, rows):
    """rows: (store, product, date, qty)."""
    return spark.createDataFrame([(s, p, d(t) if t else None, q) for s, p, t, q in rows], S.SALES)


# M1: ledger edges. Product id = root, except product 2 which has no root.
M1_PRODUCTS = [(1, 1, "X", 1, 1), (2, None, "X", 1, 1), (3, 3, "X", 1, 1), (4, 4, "X", 1, 1), (5, 5, "X", 1, 1)]
M1_MOVEMENTS = [
    (1, 1, "2018-05-01", 10), (1, 1, "2019-03-01", -4), (1, 1, "2019-06-01", -6), (1, 1, "2021-01-01", 7),
    (1, 2, "2018-01-01", 5), (1, 2, "2019-02-01", 5),
    (1, 3, "2019-01-01", 8),
    (1, 4, "2019-02-10", 5), (1, 4, "2019-02-10", -5), (1, 4, "2019-03-10", -2), (1, 4, "2019-04-10", 9),
    (1, 5, "2020-12-31", 3),
]
M1_INTERVALS = {
    (1, 1, d("2019-01-01"), d("2019-02-28"), 10),
    (1, 1, d("2019-03-01"), d("2019-05-31"), 6),
    (3, 1, d("2019-01-01"), d("2020-12-31"), 8),
    (4, 1, d("2019-04-10"), d("2020-12-31"), 7),
    (5, 1, d("2020-12-31"), d("2020-12-31"), 3),
}
M1_DAYS = {1: 59 + 92, 3: 731, 4: 632, 5: 1}

# M2: KPIs.
M2_PRODUCTS = [
    (1, 10, "A", 10, 4), (2, 10, "A", 20, 8), (3, 20, "B", None, 5),
    (4, 30, None, 7, 2), (5, None, "B", 6, 3),
]
M2_SALES = [
    (1, 1, "2019-05-01", 3), (1, 1, "2019-06-01", -1), (1, 3, "2019-05-01", 2), (1, 9, "2019-05-01", 4),
    (2, 2, "2020-02-29", 5), (1, 4, "2020-01-01", 1),
]
M2_MOVEMENTS = [
    (1, 1, "2018-12-01", 100), (1, 1, "2019-07-01", -30), (1, 2, "2019-07-01", 10), (1, 3, "2020-03-01", 6),
    (3, 9, "2019-01-05", 8), (2, 5, "2019-02-01", 7), (1, 4, "2020-06-01", 2),
]
M2_INTERVALS = {
    (10, 1, d("2019-01-01"), d("2019-06-30"), 100),
    (10, 1, d("2019-07-01"), d("2020-12-31"), 80),
    (20, 1, d("2020-03-01"), d("2020-12-31"), 6),
    (30, 1, d("2020-06-01"), d("2020-12-31"), 2),
}
# entity, year -> benefit, unpriced cost, adjusted, units, stock-days, rotation
M2_TABLE = {
    (1, 2019): (-60, 0, -60, 8, 32820, 0.088970140),
    (1, 2020): (3, 30, -27, 1, 31544, 0.011571139),
    (2, 2019): (-21, 0, -21, 0, 0, 0),
    (2, 2020): (100, 0, 100, 5, 0, 5),
    (3, 2019): (0, 0, 0, 0, 0, 0),
    (3, 2020): (0, 0, 0, 0, 0, 0),
    ("A", 2019): (-60, 0, -60, 2, 65640, 0.011121268),
    ("A", 2020): (100, 0, 100, 5, 58560, 0.031164617),
    ("B", 2019): (-21, 0, -21, 2, 0, 2),
    ("B", 2020): (0, 30, -30, 0, 1836, 0),
    (None, 2019): (0, 0, None, 0, 0, 0),
    (None, 2020): (0, 0, None, 0, 0, 0),
}
