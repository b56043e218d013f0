"""Yearly KPIs per store or per product family: benefit and rotation.

``level`` is the entity column: ``"StoreId"`` or ``"Family"``. Every result
is a full spine of entity x year, zero-filled (S14).

All KPIs read the facts through :class:`Measures`: one pass over the sales
and one over the inbound movements, each joined to the (broadcast when
small) master and pre-aggregated per (store, family, flags, year) with
map-side partial sums. Store- and family-level measures, the unpriced
branch and the adjusted benefit are then algebra on those small tables,
so a whole run scans each fact table once for the KPIs, however many
outputs it writes. Facts are filtered to the reporting years at the scan
(R6). Money is summed as Decimal, exact and order-independent, and turned
into Double at the edge.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Period
from ..functions.dates import days_in_year, in_years, overlap_days, year_of
from ..schema import MONEY, minus, worth
from .joins import fits_broadcast, maybe_broadcast

STORE, FAMILY = "StoreId", "Family"
YEAR = "Anio"
LEVELS = (STORE, FAMILY)


def zero_money():
    return F.lit(0).cast(MONEY)


def _check_level(level: str) -> None:
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}, got {level!r}")


# ---------------------------------------------------------------- universes

def store_universe(
    sales: DataFrame,
    movements: DataFrame,
    products: DataFrame | None = None,
    *,
    known_products_only: bool = False,
    master_fits: bool | None = None,
) -> DataFrame:
    """Distinct stores of sales and movements, all years (U3; S15).

    By default every movement counts, also of products missing from the
    master; ``known_products_only=True`` keeps only movements of known
    products. Only the StoreId column is read, and each side is
    de-duplicated map-side before the shuffle.
    """
    if known_products_only:
        if master_fits is None:
            master_fits = fits_broadcast(products)
        known = maybe_broadcast(products.select("ProductId"), master_fits)
        mv = movements.select("ProductId", STORE).join(known, "ProductId", "left_semi").select(STORE)
    else:
        mv = movements.select(STORE)
    return sales.select(STORE).union(mv).distinct()


def family_universe(products: DataFrame) -> DataFrame:
    """Distinct families of the master, priced or not, null included (A10; S17)."""
    return products.select(FAMILY).distinct()


def spine(entities: DataFrame, level: str, years) -> DataFrame:
    """Entity x year rows (B4): a generator over the year list, no cross join."""
    yrs = F.array(*[F.lit(int(y)) for y in years])
    return entities.select(level, F.explode(yrs).alias(YEAR))


# ---------------------------------------------------------------- fact cubes

def sales_cube(
    sales: DataFrame, products: DataFrame, period: Period, *, master_fits: bool | None = None
) -> DataFrame:
    """Sales of the reporting years per (StoreId, Family, Known, Priced, Anio).

    ``Units`` sums every quantity; ``Value`` sums Quantity x RetailPrice and
    is null where the product has no price. Products missing from the
    master stay in (Known = false): store-level units count them (S19).
    """
    if master_fits is None:
        master_fits = fits_broadcast(products)
    master = products.select(
        "ProductId",
        FAMILY,
        "RetailPrice",
        F.lit(True).alias("Known"),
    )
    facts = sales.filter(in_years("Date", period)).select(
        STORE, "ProductId", "Quantity", year_of("Date").alias(YEAR)
    )
    return (
        facts.join(maybe_broadcast(master, master_fits), "ProductId", "left")
        .groupBy(
            STORE,
            FAMILY,
            F.coalesce(F.col("Known"), F.lit(False)).alias("Known"),
            F.col("RetailPrice").isNotNull().alias("Priced"),
            YEAR,
        )
        .agg(
            F.sum("Quantity").alias("Units"),
            F.sum(worth("Quantity", "RetailPrice")).cast(MONEY).alias("Value"),
        )
    )


def inbound_cube(
    movements: DataFrame, products: DataFrame, period: Period, *, master_fits: bool | None = None
) -> DataFrame:
    """Inbound cost of the reporting years per (StoreId, Family, Priced, Anio).

    Raw movement rows with Quantity > 0, before any netting, of products in
    the master; a null SupplierPrice drops its rows out of the sum.
    """
    if master_fits is None:
        master_fits = fits_broadcast(products)
    master = products.select(
        "ProductId", FAMILY, "SupplierPrice", F.col("RetailPrice").isNotNull().alias("Priced")
    )
    facts = movements.filter((F.col("Quantity") > 0) & in_years("Date", period)).select(
        STORE, "ProductId", "Quantity", year_of("Date").alias(YEAR)
    )
    return (
        facts.join(maybe_broadcast(master, master_fits), "ProductId")
        .groupBy(STORE, FAMILY, "Priced", YEAR)
        .agg(F.sum(worth("Quantity", "SupplierPrice")).cast(MONEY).alias("Cost"))
    )


@dataclass(frozen=True)
class Measures:
    """The pre-aggregated facts every KPI of one run is computed from.

    Built lazily by :meth:`build`; a job that writes several outputs
    materialises them once with :meth:`materialize` (all four are small:
    entities x flags x years).
    """

    sales: DataFrame
    inbound: DataFrame
    stores: DataFrame
    families: DataFrame
    period: Period

    @classmethod
    def build(
        cls,
        sales: DataFrame,
        movements: DataFrame,
        products: DataFrame,
        period: Period,
        *,
        master_fits: bool | None = None,
        known_products_only: bool = False,
    ) -> "Measures":
        if master_fits is None:
            master_fits = fits_broadcast(products)
        return cls(
            sales_cube(sales, products, period, master_fits=master_fits),
            inbound_cube(movements, products, period, master_fits=master_fits),
            store_universe(
                sales,
                movements,
                products,
                known_products_only=known_products_only,
                master_fits=master_fits,
            ),
            family_universe(products),
            period,
        )

    def materialize(self, store: Callable[[DataFrame, str], DataFrame]) -> "Measures":
        """Replace each frame by ``store(frame, name)``, e.g. written and read back."""
        return replace(
            self,
            **{
                f.name: store(getattr(self, f.name), f.name)
                for f in fields(self)
                if f.name != "period"
            },
        )

    def spine(self, level: str) -> DataFrame:
        _check_level(level)
        ents = self.stores if level == STORE else self.families
        return spine(ents, level, self.period.years)


# ---------------------------------------------------------------- measures

def _conditional_sum(cube: DataFrame, level: str, cond, value: str, name: str) -> DataFrame:
    """Sum ``value`` over the cube rows meeting ``cond`` per entity and year.

    A conditional sum rather than a filter: a filter on a grouping column
    would be pushed below the cube's aggregate and make every consumer's
    copy of the cube plan differ, so two measures over one cube would scan
    the facts twice. Written this way the cube sub-plan stays identical and
    its exchange is reused. Groups with no matching row are dropped, as a
    filter would.
    """
    return (
        cube.groupBy(level, YEAR)
        .agg(
            F.sum(F.when(cond, F.col(value))).alias(name),
            F.count(F.when(cond, F.lit(1))).alias("_rows"),
        )
        .filter(F.col("_rows") > 0)
        .drop("_rows")
    )


def sales_value(m: Measures, level: str) -> DataFrame:
    """Sum of Quantity x RetailPrice of priced products per entity and year (A3; S11)."""
    _check_level(level)
    return _conditional_sum(m.sales, level, F.col("Priced"), "Value", "TotalVentas")


def inbound_cost(
    m: Measures, level: str, *, priced: bool | None = True, name: str = "TotalCostos"
) -> DataFrame:
    """Inbound cost per entity and year.

    ``priced=True`` keeps products with a retail price, ``False`` those
    without, ``None`` all.
    """
    _check_level(level)
    cond = {True: F.col("Priced"), False: ~F.col("Priced"), None: F.lit(True)}[priced]
    return _conditional_sum(m.inbound, level, cond, "Cost", name)


def units_sold(m: Measures, level: str) -> DataFrame:
    """Units sold per entity and year (A5; S19).

    Store level counts every sale, unknown products included; family level
    needs the master, so it counts known products only.
    """
    _check_level(level)
    cond = F.lit(True) if level == STORE else F.col("Known")
    return _conditional_sum(m.sales, level, cond, "Units", "UnidadesVendidas")


def stock_days(intervals: DataFrame, period: Period, by) -> DataFrame:
    """Sum of Stock x days held, per ``by`` columns and year, read off the intervals.

    Equal to summing the daily expansion, without producing it: each
    interval is split over the (at most len(years)) years it touches.
    """
    years = [int(y) for y in period.years]
    touched = F.sequence(year_of("StartDate"), year_of("EndDate"))
    per_year = intervals.select(*by, "StartDate", "EndDate", "Stock", F.explode(touched).alias(YEAR))
    return (
        per_year.filter(F.col(YEAR).isin(years))
        .groupBy(*by, YEAR)
        .agg(
            F.sum(F.col("Stock") * overlap_days("StartDate", "EndDate", F.col(YEAR))).alias(
                "StockDays"
            )
        )
    )


def mean_stock(
    intervals: DataFrame,
    products: DataFrame,
    level: str,
    period: Period,
    *,
    root_fanout: bool = True,
    master_fits: bool | None = None,
) -> DataFrame:
    """Mean stock per entity and year: stock-days / days per year (A6; S10, S20, S22).

    Days without positive stock count as zero. At family level the original
    job joins days to the master on the root code, so a root's stock counts
    once per product sharing that root (``root_fanout=True``, the default
    and the published figures); ``root_fanout=False`` counts each (root,
    family) pair once. Stock-days are summed per root first and multiplied
    by the product count afterwards (R4), which avoids fanning out rows.
    """
    _check_level(level)
    if level == STORE:
        sd = stock_days(intervals, period, [STORE])
    else:
        per_root = stock_days(intervals, period, ["ProductRootCode"])
        fam = products.filter(F.col("ProductRootCode").isNotNull()).groupBy(
            "ProductRootCode", FAMILY
        )
        fan = (
            fam.agg(F.count(F.lit(1)).alias("_n"))
            if root_fanout
            else fam.agg(F.lit(1).cast("long").alias("_n"))
        )
        sd = (
            # (root, family) pairs are no more than the master's rows
            per_root.join(maybe_broadcast(fan, fits_broadcast(products) if master_fits is None else master_fits), "ProductRootCode")
            .groupBy(FAMILY, YEAR)
            .agg(F.sum(F.col("StockDays") * F.col("_n")).alias("StockDays"))
        )
    return sd.select(
        level,
        YEAR,
        "StockDays",
        (F.col("StockDays") / days_in_year(F.col(YEAR), period.days_per_year)).alias("StockMedio"),
    )


# ---------------------------------------------------------------- KPIs

def benefit_decimal(m: Measures, level: str) -> DataFrame:
    """Benefit as exact Decimal: sales value - inbound cost, 0 where missing."""
    return (
        m.spine(level)
        .join(sales_value(m, level), [level, YEAR], "left")
        .join(inbound_cost(m, level), [level, YEAR], "left")
        .select(
            level,
            YEAR,
            minus(F.col("TotalVentas"), F.col("TotalCostos")).alias("Beneficio"),
        )
    )


def benefit(m: Measures, level: str) -> DataFrame:
    """Benefit per entity and year, as Double (the published table)."""
    b = benefit_decimal(m, level)
    return b.select(level, YEAR, F.col("Beneficio").cast("double").alias("Beneficio"))


def rotation(
    m: Measures,
    intervals: DataFrame,
    products: DataFrame,
    level: str,
    *,
    root_fanout: bool = True,
    master_fits: bool | None = None,
) -> DataFrame:
    """Units sold / mean stock per entity and year (B7, B8; S21).

    Zero or missing mean stock gives the units sold themselves.
    """
    ms = mean_stock(intervals, products, level, m.period, root_fanout=root_fanout, master_fits=master_fits).select(
        level, YEAR, "StockMedio"
    )
    units = F.coalesce(F.col("UnidadesVendidas"), F.lit(0).cast("long"))
    stock = F.col("StockMedio")
    return (
        m.spine(level)
        .join(units_sold(m, level), [level, YEAR], "left")
        .join(ms, [level, YEAR], "left")
        .select(
            level,
            YEAR,
            F.when(F.coalesce(stock, F.lit(0.0)) != 0, units / stock)
            .otherwise(units.cast("double"))
            .alias("Rotacion"),
        )
    )


def top_k(df: DataFrame, level: str, measure: str, year: int, k: int = 3) -> DataFrame:
    """The ``k`` largest ``measure`` rows of one year, ties broken by entity (L1, L2)."""
    return (
        df.filter(F.col(YEAR) == int(year))
        .orderBy(F.col(measure).desc(), F.col(level).asc_nulls_last())
        .limit(k)
    )
