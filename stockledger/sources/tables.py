"""The three retail inputs as one bundle, with a cached size check of the master."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_limit, fits_broadcast, relation_bytes
from .readers import read_movements, read_products, read_sales


@dataclass
class RetailTables:
    products: DataFrame
    sales: DataFrame
    movements: DataFrame
    #: The master as stored, before its prices were cast; the contract compares both.
    raw_products: DataFrame | None = None
    _fits: bool | None = field(default=None, repr=False)

    @property
    def spark(self) -> SparkSession:
        return self.products.sparkSession

    def products_fit_broadcast(self) -> bool:
        """Measured once per bundle: is the whole master small enough to ship?

        Any projection of the master is no larger, so the answer holds for
        every join below.
        """
        if self._fits is None:
            self._fits = fits_broadcast(self.products)
        return self._fits

    def repeated_products(self) -> int:
        """Product rows beyond the first of their id; measures the master for joins in the same pass."""
        per_id = self.products.groupBy("ProductId").agg(F.count(F.lit(1)).alias("c"), F.max(F.octet_length("Family")).alias("w"))
        row = per_id.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("more"), F.coalesce(F.max("w"), F.lit(0)).alias("w")).first()
        self._fits = relation_bytes(row["n"], len(self.products.columns), row["w"]) <= broadcast_limit(self.products)
        return int(row["more"])

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, products: str, sales: str, movements: str
    ) -> "RetailTables":
        return cls(
            read_products(spark, products),
            read_sales(spark, sales),
            read_movements(spark, movements),
            raw_products=spark.read.parquet(products),
        )
