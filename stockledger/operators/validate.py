"""Data-quality jobs over every key (V1-V8).

Each job returns one row per check: ``(check, n_checked, n_violations)``,
computed as a distributed aggregate. The ``*_violations`` siblings return
the offending rows themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Period
from ..functions.dates import days_in_year, in_years, year_of
from ..schema import MONEY, PRICE, minus, worth
from .joins import fits_broadcast, maybe_broadcast
from .kpi import FAMILY, STORE, YEAR
from .ledger import KEY, stock_as_of

# Fixed tolerance for comparing recomputed money and ratios.
TOLERANCE = 1e-9


def _summary(name: str, df: DataFrame, bad) -> DataFrame:
    return df.agg(
        F.lit(name).alias("check"),
        F.count(F.lit(1)).alias("n_checked"),
        F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("long").alias("n_violations"),
    )


# ---------------------------------------------------------------- intervals

def positive_violations(intervals: DataFrame) -> DataFrame:
    """Intervals without positive stock (V1)."""
    return intervals.filter(F.col("Stock") <= 0)


def check_positive(intervals: DataFrame) -> DataFrame:
    """V1: every interval holds positive stock."""
    return _summary("positive_stock", intervals, F.col("Stock") <= 0)


def _balances(intervals: DataFrame, rooted: DataFrame) -> DataFrame:
    pts = intervals.select(*KEY, F.col("StartDate").alias("AsOf"), "Stock")
    return stock_as_of(rooted, pts, carry=["Stock"])


def _unbalanced():
    return F.col("Balance").isNull() | (F.col("Balance") != F.col("Stock"))


def balance_violations(intervals: DataFrame, rooted: DataFrame) -> DataFrame:
    """Intervals whose Stock differs from the sum of raw movements up to StartDate (V2)."""
    return _balances(intervals, rooted).filter(_unbalanced())


def check_interval_balance(intervals: DataFrame, rooted: DataFrame) -> DataFrame:
    """V2, every interval: balance of all movements on or before its start = its Stock."""
    return _summary("interval_balance", _balances(intervals, rooted), _unbalanced())


def _day_masks(intervals: DataFrame, daily: DataFrame, partitions: int | None = None, *, starts: bool = False) -> DataFrame:
    """Per (key, month, stock): days and rows the daily table holds, and the days its intervals imply.

    A month's days are the bits of one number. Daily rows are OR-ed and counted
    map-side, so the shuffle moves about one row per key, month and stock
    instead of one per day; an interval gives one row per month it touches.

    ``starts`` lists the intervals too. Lists make Spark sort what it
    aggregates, so the daily rows are then reduced to their masks first.

    With ``partitions``, daily rows are reduced too and key's months dealt to that many tasks
    (see :func:`~.ledger.daily_partitions`): a task's share does not grow with the table.
    """
    month = F.explode(F.sequence(F.trunc("StartDate", "month"), F.trunc("EndDate", "month"), F.expr("interval 1 month")))
    touched = intervals.select(*KEY, "Stock", "StartDate", "EndDate", month.alias("Month"))
    first = F.day(F.greatest("StartDate", "Month"))
    last = F.day(F.least("EndDate", F.last_day("Month")))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    implied = F.call_function("shiftleft", one, last + 1) - F.call_function("shiftleft", one, first)
    iv = touched.select(*KEY, "Month", "Stock", implied.alias("implied"), none.alias("days"), none.alias("rows"), F.struct("StartDate", implied.alias("mask")).alias("interval"))
    held = daily.select(
        *KEY, F.trunc("Date", "month").alias("Month"), "Stock", none.alias("implied"),
        F.coalesce(F.call_function("shiftleft", one, F.day("Date")), none).alias("days"), one.alias("rows"),
    )
    sums = [F.bit_or("days").alias("days"), F.sum("rows").alias("rows"), F.bit_or("implied").alias("implied")]
    by = [*KEY, "Month", "Stock"]
    dealt = lambda df: df if partitions is None else df.repartition(partitions, *KEY, "Month")
    if not starts:
        held = held if partitions is None else held.groupBy(*by).agg(*sums)
        return dealt(iv.drop("interval").unionByName(held)).groupBy(*by).agg(*sums)
    held = held.groupBy(*by).agg(*sums).withColumn("interval", F.lit(None).cast(iv.schema["interval"].dataType))
    # at most one interval for each day of the month
    return dealt(iv.unionByName(held)).groupBy(*by).agg(*sums, F.collect_list("interval").alias("intervals"))


def check_daily_expansion(intervals: DataFrame, daily: DataFrame, partitions: int | None = None) -> DataFrame:
    """V3: every interval has DATEDIFF + 1 daily rows of its stock, and no day is stray.

    n_checked counts intervals. A violation is an interval that lacks a day, a
    daily row inside no interval or with another stock, or each extra copy of a
    repeated row.
    """
    masks = _day_masks(intervals, daily, partitions, starts=True)
    stray = F.bit_count(F.col("days").bitwiseAND(F.bitwise_not("implied"))) + F.col("rows") - F.bit_count("days")
    lacking = F.filter("intervals", lambda i: i["mask"].bitwiseAND(F.bitwise_not(F.col("days"))) != 0)
    per = masks.select(*KEY, stray.alias("all"), F.posexplode_outer(F.transform(lacking, lambda i: i["StartDate"])).alias("pos", "StartDate"))
    # a month's strays are counted once, though several of its intervals may lack days
    once = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("all")).otherwise(0)
    per = per.groupBy(*KEY, "StartDate").agg(F.sum(once).alias("stray"))
    bad = per.agg(F.sum("stray").alias("s"), F.count("StartDate").alias("lacking"))
    total = intervals.agg(F.count(F.lit(1)).alias("n_checked"))
    return total.select("n_checked", F.lit(0).cast("long").alias("n")).unionByName(
        bad.select(F.lit(0).cast("long").alias("n_checked"), (F.coalesce("s", F.lit(0)) + F.col("lacking")).cast("long").alias("n"))
    ).agg(F.lit("daily_expansion").alias("check"), F.sum("n_checked").alias("n_checked"), F.sum("n").alias("n_violations"))


def _month_days(mask):
    """The days of the month whose bits are set."""
    one = F.lit(1).cast("long")
    return F.filter(F.sequence(F.lit(1), F.lit(31)), lambda d: mask.bitwiseAND(F.call_function("shiftleft", one, d)) != 0)


def _same_key(left: str, right: str, *more: str):
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in (*KEY, *more)])


def daily_violations(intervals: DataFrame, daily: DataFrame, partitions: int | None = None) -> DataFrame:
    """The days behind V3: Problem, key, Date, Stock held, Stock expected and extra copies.

    ``missing``: a day of an interval without any row. ``wrong_stock``: a row
    whose day lies in an interval of another stock. ``stray``: a row whose day
    lies in none. ``repeated``: a row that stands more than once, with the
    number of extra copies; it may be wrong or stray as well. ``undated``: rows
    without a date.

    The day masks of a (key, month, stock) are decoded back into days, so only
    offending days become rows; nothing is sorted or windowed day by day. The
    daily table is read a second time for the months whose row count exceeds
    their days, to tell which day repeats. With ``partitions``, ``daily`` is to
    be dealt by key into so many tasks, and months are too.
    """
    masks = _day_masks(intervals, daily, partitions)
    # what a key's month expects (disjoint intervals: at most one entry a day) and holds, whatever the stock
    planned = F.when(F.col("implied") != 0, F.struct("implied", "Stock"))
    parts = F.collect_list(F.struct("Stock", "implied", "days")).alias("parts")
    month = masks.where(F.col("Month").isNotNull()).groupBy(*KEY, "Month").agg(F.collect_list(planned).alias("plan"), F.bit_or("days").alias("held"), parts)
    both = month.select(*KEY, "Month", "plan", "held", F.inline("parts"))

    lacking = F.col("implied").bitwiseAND(F.bitwise_not("held"))
    surplus = F.col("days").bitwiseAND(F.bitwise_not("implied"))
    bit = lambda d: F.call_function("shiftleft", F.lit(1).cast("long"), d)
    expected = lambda d: F.get(F.filter("plan", lambda p: p["implied"].bitwiseAND(bit(d)) != 0), F.lit(0))["Stock"]
    nothing = F.lit(None).cast("long")
    held = F.transform(
        _month_days(surplus),
        lambda d: F.struct(
            F.when(expected(d).isNull(), "stray").otherwise("wrong_stock").alias("Problem"), d.alias("day"), F.col("Stock").alias("Stock"), expected(d).alias("Expected")
        ),
    )
    absent = F.transform(
        _month_days(lacking), lambda d: F.struct(F.lit("missing").alias("Problem"), d.alias("day"), nothing.alias("Stock"), F.col("Stock").alias("Expected"))
    )
    days = both.where((lacking != 0) | (surplus != 0)).select(*KEY, "Month", F.explode(F.concat(held, absent)).alias("v")).select(
        "v.Problem", *KEY, F.expr("date_add(Month, v.day - 1)").alias("Date"), "v.Stock", "v.Expected", F.lit(0).cast("long").alias("Extra")
    )

    crowded = masks.where(F.col("rows") > F.bit_count("days")).select(*KEY, "Month", "Stock")
    dated = daily.select(*KEY, "Date", "Stock", F.trunc("Date", "month").alias("Month"))
    # days dealt by key into sized tasks are counted where they are, without a shuffle; others only where a month is crowded
    again = dated if partitions else dated.alias("d").join(crowded.alias("c"), _same_key("d", "c", "Month", "Stock"), "left_semi")
    counted = again.groupBy(*KEY, "Date", "Stock").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or Date is null")
    repeated = counted.select(
        F.when(F.col("Date").isNull(), "undated").otherwise("repeated").alias("Problem"), *KEY, "Date", "Stock", nothing.alias("Expected"),
        (F.col("n") - F.when(F.col("Date").isNull(), 0).otherwise(1)).cast("long").alias("Extra"),
    )
    return days.unionByName(repeated)


# ---------------------------------------------------------------- KPIs

def _close(a, b):
    return F.abs(a - b) <= F.lit(TOLERANCE) * F.greatest(F.lit(1.0), F.abs(a), F.abs(b))


def kpi_facts(
    sales: DataFrame,
    movements: DataFrame,
    products: DataFrame,
    period: Period,
    *,
    master_fits: bool | None = None,
) -> DataFrame:
    """Units, sales value and inbound cost per (store, year) and per (family, year), recomputed for V4-V7.

    One grouping-sets aggregate of each fact table: ``Level`` names the entity
    a row belongs to, ``Known`` whether its products are in the master (store
    units count unknown products, family units do not). Computed another way
    than the published figures: the price condition sits inside the sums
    instead of in the join, with no flags, spine or left joins of measures. A
    run writes this small table once and all four checks read it.
    """
    if master_fits is None:
        master_fits = fits_broadcast(products)
    master = maybe_broadcast(products.select("ProductId", FAMILY, "RetailPrice", "SupplierPrice", F.lit(True).alias("Known")), master_fits)
    priced, none = F.col("RetailPrice").isNotNull(), F.lit(None).cast(MONEY)
    known = F.coalesce("Known", F.lit(False))

    def per_entity(facts: DataFrame, price: str, *measures) -> DataFrame:
        rows = facts.join(master, "ProductId", "left").select(
            STORE, FAMILY, known.alias("Known"), year_of("Date").alias(YEAR), F.col("Quantity").alias("Units"),
            F.when(priced, worth("Quantity", price)).alias("Worth"),
        )
        sets = rows.groupingSets([["Known", STORE, YEAR], ["Known", FAMILY, YEAR]], "Known", STORE, FAMILY, YEAR)
        return sets.agg(F.when(F.grouping(STORE) == 0, STORE).otherwise(FAMILY).alias("Level"), *measures)

    sold = per_entity(sales.filter(in_years("Date", period)), "RetailPrice", F.sum("Units").alias("Units"), F.sum("Worth").cast(MONEY).alias("SalesValue"))
    received = per_entity(movements.filter((F.col("Quantity") > 0) & in_years("Date", period)), "SupplierPrice", F.sum("Worth").cast(MONEY).alias("InboundCost"))
    return sold.withColumn("InboundCost", none).unionByName(received.withColumns({"Units": F.lit(None).cast("long"), "SalesValue": none}))


def _of_level(facts: DataFrame, level: str) -> DataFrame:
    return facts.where(F.col("Level") == level) if "Level" in facts.columns else facts


def benefit_facts(
    sales: DataFrame,
    movements: DataFrame,
    products: DataFrame,
    period: Period,
    *,
    master_fits: bool | None = None,
) -> DataFrame:
    """Sales value and inbound cost per (store, family, year), recomputed for V4/V5.

    Computed another way than the published figures: the price condition
    sits inside the sums instead of in the join, with no flags, spine or
    left joins. One pass over each fact table serves both levels; a run
    checking both writes this small table once (``run_checks``).
    """
    if master_fits is None:
        master_fits = fits_broadcast(products)
    master = maybe_broadcast(
        products.select("ProductId", FAMILY, "RetailPrice", "SupplierPrice"), master_fits
    )
    priced = F.col("RetailPrice").isNotNull()
    keys = [STORE, FAMILY, year_of("Date").alias(YEAR)]
    sv = (
        sales.filter(in_years("Date", period))
        .join(master, "ProductId")
        .groupBy(*keys)
        .agg(
            F.sum(F.when(priced, worth("Quantity", "RetailPrice"))).cast(MONEY).alias("SalesValue"),
            F.lit(None).cast(MONEY).alias("InboundCost"),
        )
    )
    ic = (
        movements.filter((F.col("Quantity") > 0) & in_years("Date", period))
        .join(master, "ProductId")
        .groupBy(*keys)
        .agg(
            F.lit(None).cast(MONEY).alias("SalesValue"),
            F.sum(F.when(priced, worth("Quantity", "SupplierPrice"))).cast(MONEY).alias("InboundCost"),
        )
    )
    return sv.unionByName(ic)


def _benefits(published: DataFrame, facts: DataFrame, level: str) -> DataFrame:
    re = _of_level(facts, level).groupBy(level, YEAR).agg(
        F.sum("SalesValue").alias("_sv"), F.sum("InboundCost").alias("_ic")
    )
    return published.join(re, [level, YEAR], "left").select(
        level, YEAR, F.col("Beneficio").alias("Published"), minus(F.col("_sv"), F.col("_ic")).cast("double").alias("Recomputed")
    )


def _off():
    return ~_close(F.col("Published"), F.col("Recomputed")) | F.col("Published").isNull()


def check_benefit(published: DataFrame, facts: DataFrame, level: str) -> DataFrame:
    """V4, V5: each published benefit = sales value - inbound cost, from :func:`benefit_facts`."""
    return _summary(f"{level.lower()}_benefit", _benefits(published, facts, level), _off())


def benefit_violations(published: DataFrame, facts: DataFrame, level: str) -> DataFrame:
    """Entity, year, published and recomputed benefit where they differ (V4, V5)."""
    return _benefits(published, facts, level).filter(_off())


def daily_stock_days(daily: DataFrame, period: Period) -> DataFrame:
    """Sum of daily stock per (store, root, year) over the reporting years.

    The first step of both rotation checks; a run checking both levels
    computes it once (``run_checks`` writes it and reads it back).
    """
    return (
        daily.filter(in_years("Date", period))
        .groupBy(STORE, "ProductRootCode", year_of("Date").alias(YEAR))
        .agg(F.sum("Stock").alias("StockDays"))
    )


def _rotations(
    published: DataFrame,
    sales: DataFrame,
    products: DataFrame,
    stock_days: DataFrame,
    level: str,
    period: Period,
    *,
    root_fanout: bool = True,
    master_fits: bool | None = None,
    facts: DataFrame | None = None,
) -> DataFrame:
    if master_fits is None:
        master_fits = fits_broadcast(products)
    if level == STORE:
        sd = stock_days.groupBy(STORE, YEAR).agg(F.sum("StockDays").alias("_sd"))
    else:
        per_root = stock_days.groupBy("ProductRootCode", YEAR).agg(
            F.sum("StockDays").alias("_rsd")
        )
        fam = products.filter(F.col("ProductRootCode").isNotNull()).groupBy("ProductRootCode", FAMILY)
        fan = fam.count() if root_fanout else fam.agg(F.lit(1).cast("long").alias("count"))
        sd = (
            per_root.join(maybe_broadcast(fan, master_fits), "ProductRootCode")  # no larger than the master
            .groupBy(FAMILY, YEAR)
            .agg(F.sum(F.col("_rsd") * F.col("count")).alias("_sd"))
        )
    if facts is not None:
        known = _of_level(facts, level)
        us = (known if level == STORE else known.where("Known")).groupBy(level, YEAR).agg(F.sum("Units").alias("_units"))
    else:
        s = sales.filter(in_years("Date", period))
        if level == FAMILY:
            s = s.join(maybe_broadcast(products.select("ProductId", FAMILY), master_fits), "ProductId")
        us = s.groupBy(level, year_of("Date").alias(YEAR)).agg(F.sum("Quantity").alias("_units"))
    units = F.coalesce(F.col("_units"), F.lit(0)).cast("double")
    mean = F.coalesce(F.col("_sd"), F.lit(0)) / days_in_year(F.col(YEAR), period.days_per_year)
    re = (
        published.join(us, [level, YEAR], "left")
        .join(sd, [level, YEAR], "left")
        .select(level, YEAR, F.col("Rotacion").alias("Published"), F.when(mean != 0, units / mean).otherwise(units).alias("Recomputed"))
    )
    return re


def check_rotation(published, sales, products, stock_days, level: str, period: Period, **how) -> DataFrame:
    """V6, V7: each published rotation = units / (sum of daily stock / days).

    ``stock_days`` is :func:`daily_stock_days` of the exploded daily table,
    so mean stock is checked independently of the interval arithmetic used
    to publish it. With ``facts`` (:func:`kpi_facts`) the units sold come from
    that table and ``sales`` is not read.
    """
    rows = _rotations(published, sales, products, stock_days, level, period, **how)
    return _summary(f"{level.lower()}_rotation", rows, _off())


def rotation_violations(published, sales, products, stock_days, level: str, period: Period, **how) -> DataFrame:
    """Entity, year, published and recomputed rotation where they differ (V6, V7)."""
    return _rotations(published, sales, products, stock_days, level, period, **how).filter(_off())


# ---------------------------------------------------------------- contract

def _rule_rows(agg: DataFrame, rules: list[tuple[str, str]], n_col: str = "_n") -> DataFrame:
    """Unpivot a one-row aggregate into ``(check, n_checked, n_violations)`` rows."""
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(n_col).cast("long").alias("n_checked"),
            F.coalesce(F.col(col), F.lit(0)).cast("long").alias("n_violations"),
        )
        for name, col in rules
    ]
    return agg.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def _null_rules(name: str, df: DataFrame, cols, extra=()):
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"_null_{c}") for c in cols]
    aggs += [a for a, _ in extra]
    rules = [(f"{name}_{c.lower()}_not_null", f"_null_{c}") for c in cols]
    rules += [r for _, r in extra]
    return _rule_rows(df.agg(*aggs), rules)


def _digits_lost(raw: DataFrame):
    lost = F.lit(False)
    for c in ("RetailPrice", "SupplierPrice"):
        kept = F.col(c).cast(PRICE).cast(raw.schema[c].dataType)
        lost = lost | F.coalesce(kept != F.col(c), F.lit(False))
    return lost


def check_price_digits(raw_products: DataFrame) -> DataFrame:
    """Products with a price that the declared type does not hold exactly."""
    return _summary("price_digits_kept", raw_products, _digits_lost(raw_products))


def _broken(rules: dict[str, object]):
    """The names of the rules that a row breaks."""
    return F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules.items())), lambda r: r.isNotNull())


def contract_violations(
    products: DataFrame, sales: DataFrame, movements: DataFrame, *, raw_products: DataFrame | None = None, master_fits: bool | None = None
) -> DataFrame:
    """The rows behind V8: rule, ProductId, StoreId and Date of each offending row.

    Each table is read once: a row carries the list of the rules it breaks and
    gives a row for each. The master's rules are counted per product id, and
    the same counts say which movements' products are known.
    """
    if master_fits is None:
        master_fits = fits_broadcast(products)
    raw = products if raw_products is None else raw_products
    whole = lambda bad: F.sum(bad.cast("long"))
    ids = raw.select(
        F.col("ProductId").cast("long").alias("_id"), F.col("ProductRootCode").isNull().alias("_rootless"), _digits_lost(raw).alias("_lossy")
    ).groupBy("_id").agg(F.count(F.lit(1)).alias("_c"), whole(F.col("_rootless")).alias("_r"), whole(F.col("_lossy")).alias("_l"))
    times = lambda rule, n: F.array_repeat(F.lit(rule), n.cast("int"))
    broken = F.concat(times("unique_product_id", F.col("_c") - 1), times("product_root_not_null", F.col("_r")), times("price_digits_kept", F.col("_l")))
    parts = [ids.select(F.explode(broken).alias("rule"), F.col("_id").alias("ProductId"), F.lit(None).cast("long").alias(STORE), F.lit(None).cast("date").alias("Date"))]
    # both uses of the counts must be one plan to share one exchange: every count is part of the
    # test, and the join is null-safe, as a plain one would filter null ids on its side only
    unknown = F.coalesce("_c", "_r", "_l").isNull() | F.col("ProductId").isNull()
    rooted = movements.join(maybe_broadcast(ids, master_fits), F.col("ProductId").eqNullSafe(F.col("_id")), "left")
    for name, df, more in (
        ("movements", rooted, {"unknown_product_movements": unknown}),
        ("sales", sales, {}),
    ):
        rules = {f"{name}_{c.lower()}_not_null": F.col(c).isNull() for c in ("Date", STORE, "ProductId", "Quantity")} | more
        listed = df.select("ProductId", STORE, "Date", _broken(rules).alias("_rules")).where(F.size("_rules") > 0)
        parts.append(listed.select(F.explode("_rules").alias("rule"), "ProductId", STORE, "Date"))
    return reduce(DataFrame.unionByName, parts)


def gate(products: DataFrame, sales: DataFrame, movements: DataFrame) -> dict[str, int]:
    """Counts of the violations that make published figures wrong: repeated ids and null dates."""
    ids = products.groupBy("ProductId").agg(F.count(F.lit(1)).alias("_c"))
    row = ids.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("n")).first()
    found = {"unique_product_id": int(row["n"])}
    for name, df in (("movements", movements), ("sales", sales)):
        found[f"{name}_date_not_null"] = int(df.agg(F.count_if(F.col("Date").isNull()).alias("n")).first()["n"])
    return found


def check_contract(
    products: DataFrame,
    sales: DataFrame,
    movements: DataFrame,
    *,
    master_fits: bool | None = None,
    raw_products: DataFrame | None = None,
) -> DataFrame:
    """V8: input contract (S2, S16, S26), one row per rule.

    ``price_digits_kept`` counts products of ``raw_products`` (the master as
    stored) with a price that its Decimal type does not hold exactly.

    One pass over each table: every rule of a table is a column of one
    aggregate, unpivoted afterwards. ``unknown_product_movements`` is
    informational: such rows are dropped by design (S1).
    """
    cols = ("Date", "StoreId", "ProductId", "Quantity")
    per_id = products.groupBy("ProductId").agg(
        F.count(F.lit(1)).alias("_c"),
        F.sum(F.col("ProductRootCode").isNull().cast("long")).alias("_nr"),
    )
    master = _rule_rows(
        per_id.agg(
            F.sum("_c").alias("_n"),
            F.sum(F.when(F.col("_c") > 1, F.col("_c") - 1).otherwise(0)).alias("_dup"),
            F.sum("_nr").alias("_noroot"),
        ),
        [("unique_product_id", "_dup"), ("product_root_not_null", "_noroot")],
    )
    if master_fits is None:
        master_fits = fits_broadcast(products)
    known = products.select("ProductId").distinct().withColumn("_known", F.lit(True))
    mv = movements.join(maybe_broadcast(known, master_fits), "ProductId", "left")
    unknown = (
        F.sum(F.col("_known").isNull().cast("long")).alias("_unknown"),
        ("unknown_product_movements", "_unknown"),
    )
    return reduce(
        DataFrame.unionByName,
        [master, check_price_digits(products if raw_products is None else raw_products), _null_rules("movements", mv, cols, [unknown]), _null_rules("sales", sales, cols)],
    )
