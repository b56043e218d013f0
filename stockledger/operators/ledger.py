"""Stock ledger: running balance per root product and store, as intervals and days.

Plan shape (checked with ``explain``): movements are joined to the master
(broadcast when its measured size allows), netted per (root, store, day)
with a map-side partial aggregate, then one window per (root, store) gives
both the running balance and the next ledger date. That is two shuffles,
and the window of any key holds at most one row per day of the period plus
one opening row, however many movements a hot key has.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Period
from ..functions.dates import day_series
from .joins import fits_broadcast, maybe_broadcast

KEY = ["ProductRootCode", "StoreId"]


def _by_key() -> Window:
    return Window.partitionBy(*KEY).orderBy("Date")


def attach_root(
    movements: DataFrame,
    products: DataFrame,
    *,
    drop_null_root: bool = True,
    master_fits: bool | None = None,
) -> DataFrame:
    """Movements of known products with their root code (J1; S1, S2).

    Movements of products missing from the master are dropped (inner join).
    Products without a root code are dropped too, as the requirement states.
    """
    master = products.select("ProductId", "ProductRootCode")
    if drop_null_root:
        master = master.filter(F.col("ProductRootCode").isNotNull())
    if master_fits is None:
        master_fits = fits_broadcast(products)
    return movements.join(maybe_broadcast(master, master_fits), "ProductId").select(
        "StoreId", "ProductId", "Date", "Quantity", "ProductRootCode"
    )


def net_by_product(movements: DataFrame, period: Period | None = None) -> DataFrame:
    """Net quantity per (product, store, day), folded to the period like :func:`net_movements`.

    For a master too large to broadcast: summed before the join, so the shuffle
    on ProductId carries at most one row per product, store and day, however
    many movements a hot product has.
    """
    return _folded(movements, period).groupBy("ProductId", "StoreId", "Date").agg(F.sum("Quantity").alias("Quantity"))


def _folded(movements: DataFrame, period: Period | None) -> DataFrame:
    """Dated movements; with a period, up to its closing day, those before the opening day moved onto it."""
    m = movements.filter(F.col("Date").isNotNull())
    if period is None:
        return m
    return m.filter(F.col("Date") <= F.lit(period.closing)).withColumn("Date", F.greatest(F.col("Date"), F.lit(period.opening)))


def net_movements(rooted: DataFrame, period: Period | None = None) -> DataFrame:
    """Net quantity per (root, store, day) (A1; S3).

    With a period, movements after the closing day are dropped at the scan
    (R2) and earlier-than-opening days fold onto the opening day (R1), so
    the running balance on that day is the opening balance (S5). Null dates
    are left out here; the contract check counts them (S26).
    """
    return _folded(rooted, period).groupBy(*KEY, "Date").agg(F.sum("Quantity").alias("Quantity"))


def running_stock(net: DataFrame) -> DataFrame:
    """Cumulative balance per (root, store) in date order (W1; S4)."""
    w = _by_key().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return net.select(*KEY, "Date", "Quantity", F.sum("Quantity").over(w).alias("Stock"))


def stock_ledger(
    movements: DataFrame,
    products: DataFrame,
    period: Period,
    *,
    master_fits: bool | None = None,
) -> DataFrame:
    """Balance on every ledger day of the period, opening day first (B1).

    Where the master does not fit a broadcast, movements are netted by product
    before they are shuffled to it (sums of sums, equal in exact integers).
    """
    if master_fits is None:
        master_fits = fits_broadcast(products)
    if not master_fits:
        movements = net_by_product(movements, period)
    rooted = attach_root(movements, products, master_fits=master_fits)
    return running_stock(net_movements(rooted, period)).select(*KEY, "Date", "Stock")


def interval_stock(ledger: DataFrame, period: Period) -> DataFrame:
    """Date intervals of constant positive stock (B2; S7, S8).

    The next ledger day is taken before the positive-stock filter, so a
    day whose balance drops to zero or below still ends the previous
    interval without opening one of its own. The last interval of a key
    ends on the closing day.
    """
    nxt = F.lead("Date").over(_by_key())
    return (
        ledger.select(*KEY, "Date", "Stock", nxt.alias("_next"))
        .filter(F.col("Stock") > 0)
        .select(
            *KEY,
            F.col("Date").alias("StartDate"),
            F.coalesce(F.date_sub("_next", 1), F.lit(period.closing)).alias("EndDate"),
            "Stock",
        )
    )


# Fixed defaults: in-memory width of one daily row (root, store, date, stock,
# year) and the output size aimed at per task when expanding to days.
DAILY_ROW_BYTES = 40
DAILY_BYTES_PER_TASK = 128 * 1024 * 1024


def daily_partitions(intervals: DataFrame, bytes_per_task: int = DAILY_BYTES_PER_TASK) -> int:
    """Tasks for the daily expansion, sized for its output rather than its input.

    Every interval becomes DATEDIFF + 1 rows (about 41 on the driver tables),
    so partitions sized for the intervals give tasks far too large for the
    days they produce. One aggregate over the intervals gives the exact day
    count; call it on a written (small) interval table.
    """
    days = intervals.agg(
        F.coalesce(F.sum(F.datediff("EndDate", "StartDate") + 1), F.lit(0))
    ).first()[0]
    return max(1, math.ceil(days * DAILY_ROW_BYTES / bytes_per_task))


def daily_stock(intervals: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per day of every interval, both ends included (B3; S9, S10).

    A narrow generator: without ``partitions`` there is no shuffle and the
    output follows the intervals' partitions. With it, the intervals are
    first hash-partitioned by key into that many tasks (see
    :func:`daily_partitions`), which moves the intervals, not the days.
    """
    if partitions is not None:
        intervals = intervals.repartition(partitions, *KEY)
    return intervals.select(*KEY, day_series("StartDate", "EndDate").alias("Date"), "Stock")


def stock_as_of(
    rooted: DataFrame, points: DataFrame, as_of: str = "AsOf", carry=()
) -> DataFrame:
    """Balance of each (root, store, as_of) point: sum of Quantity with Date <= as_of.

    Instead of a range join (which pairs every point with every earlier
    movement of its key) the points are merged into the movement stream and a
    running sum is read off at each. One aggregate with map-side sums nets the
    movements of a day and merges equal points, which are repeated at the end:
    the window of a key holds at most a row for each day of its history and
    for each different point, however many movements it has and however often
    it is asked. A point with no movement on or before its day, or without a
    day, gets a null balance, as SUM over no rows does. ``carry`` columns of
    the points pass through; points that differ in them are different.
    """
    carry = list(carry)
    types = dict(points.dtypes)
    own = [f"_c{i}" for i in range(len(carry))]
    one, none = F.lit(1).cast("long"), F.lit(None).cast("long")
    moves = rooted.filter(F.col("Date").isNotNull()).select(
        *KEY, "Date", *(F.lit(None).cast(types[c]).alias(n) for c, n in zip(carry, own, strict=True)), "Quantity", F.lit(0).cast("long").alias("_asked")
    )
    asked = points.select(
        *KEY, F.col(as_of).alias("Date"), *(F.col(c).alias(n) for c, n in zip(carry, own, strict=True)), none.alias("Quantity"), one.alias("_asked")
    )
    days = moves.unionByName(asked).groupBy(*KEY, "Date", *own).agg(
        F.sum("Quantity").alias("_q"), F.count("Quantity").alias("_n"), F.sum("_asked").alias("_asked")
    )
    # a range frame: everything of a day counts for every point of that day
    w = _by_key().rangeBetween(Window.unboundedPreceding, Window.currentRow)
    read = days.select(*KEY, "Date", *own, "_asked", F.sum("_q").over(w).alias("_total"), F.sum("_n").over(w).alias("_seen")).filter("_asked > 0")
    return read.select(
        *KEY, F.col("Date").alias(as_of), *(F.col(n).alias(c) for c, n in zip(carry, own, strict=True)),
        F.when(F.col("_seen") > 0, F.col("_total")).alias("Balance"),
        F.explode(F.array_repeat(F.lit(1), F.col("_asked").cast("int"))).alias("_copy"),
    ).drop("_copy")


def interval_band(intervals: DataFrame, low: int, high: int, k: int = 3) -> DataFrame:
    """The ``k`` smallest intervals with Stock in [low, high] and their day span (L3)."""
    return (
        intervals.filter(F.col("Stock").between(low, high))
        .select("*", F.datediff("EndDate", "StartDate").alias("DaySpan"))
        .orderBy("Stock", *KEY, "StartDate")
        .limit(k)
    )


def latest_interval(intervals: DataFrame, n: int | None = None) -> DataFrame:
    """Latest interval start per (root, store).

    Every key by default. ``n`` keeps a sample of the first ``n`` keys in key
    order (the original sampled with an unordered LIMIT, L4).
    """
    latest = intervals.groupBy(*KEY).agg(F.max("StartDate").alias("StartDate"))
    return latest if n is None else latest.orderBy(*KEY).limit(n)
