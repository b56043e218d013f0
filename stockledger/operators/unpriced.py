"""Products without a retail price: listing, their inbound cost, adjusted benefit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import year_entity_label
from ..schema import MONEY, minus
from .kpi import FAMILY, STORE, YEAR, zero_money, Measures, benefit_decimal, inbound_cost


def unpriced_products(products: DataFrame) -> DataFrame:
    """Master rows with no retail price."""
    return products.filter(F.col("RetailPrice").isNull())


def unpriced_by_family(products: DataFrame) -> DataFrame:
    """Number of unpriced products per family."""
    return unpriced_products(products).groupBy(FAMILY).agg(F.count(F.lit(1)).alias("Cantidad"))


def unpriced_cost_decimal(m: Measures, level: str) -> DataFrame:
    """Inbound cost of unpriced products per entity and year, 0-filled, as Decimal."""
    cost = inbound_cost(m, level, priced=False, name="TotalCosto")
    return m.spine(level).join(cost, [level, YEAR], "left").select(
        level, YEAR, F.coalesce("TotalCosto", zero_money()).alias("TotalCosto")
    )


def unpriced_cost(m: Measures, level: str) -> DataFrame:
    c = unpriced_cost_decimal(m, level)
    return c.select(level, YEAR, F.col("TotalCosto").cast("double").alias("TotalCosto"))


def unpriced_total(m: Measures) -> DataFrame:
    """Grand total of the store-level unpriced cost (A9): one row.

    Summed straight from the inbound cube: the 0-filled spine adds nothing, and
    a null store's cost stays out, as it matches no spine row.
    """
    own = ~F.col("Priced") & F.col(STORE).isNotNull()
    total = F.coalesce(F.sum(F.when(own, F.col("Cost"))), zero_money())
    return m.inbound.agg(total.cast(MONEY).cast("double").alias("TotalCosto"))


def adjusted_benefit(m: Measures, level: str) -> DataFrame:
    """Benefit minus the unpriced products' cost (B12, B13; S18).

    Store level pairs the two tables with an inner join, family level with
    a left join: the null family matches nothing there, so its adjusted
    benefit is null, as published.
    """
    b = benefit_decimal(m, level)
    c = unpriced_cost_decimal(m, level)
    how = "inner" if level == STORE else "left"
    return b.join(c, [level, YEAR], how).select(
        level,
        YEAR,
        F.when(F.col("TotalCosto").isNotNull(), minus(F.col("Beneficio"), F.col("TotalCosto"))).cast("double").alias("TotalBeneficio"),
    )


def labelled(df: DataFrame, level: str, measure: str) -> DataFrame:
    """``<year> - <entity>`` label and one measure, sorted by the label as text."""
    name = f"{YEAR}_{level}"
    return df.select(year_entity_label(YEAR, level).alias(name), measure).orderBy(name)
