"""Parquet readers for the retail inputs and the published outputs (IO1-IO4)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from .published import current_folder


def _read(spark: SparkSession, path: str, struct) -> DataFrame:
    return S.conform(spark.read.parquet(path), struct)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product master: ProductId, ProductRootCode, Family, RetailPrice, SupplierPrice."""
    return _read(spark, path, S.PRODUCTS)


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sales: StoreId, ProductId, Date, Quantity."""
    return _read(spark, path, S.SALES)


def read_movements(spark: SparkSession, path: str) -> DataFrame:
    """Signed stock movements: StoreId, ProductId, Date, Quantity."""
    return _read(spark, path, S.MOVEMENTS)


def read_outputs(spark: SparkSession, out_dir: str, names=S.OUTPUTS) -> dict[str, DataFrame]:
    """Published outputs of a job run, keyed by output name: of the current set, or of a flat folder."""
    folder = current_folder(spark, out_dir)
    frames = {n: spark.read.parquet(os.path.join(folder, f"{n}.parquet")) for n in names}
    # the year that daily_stock is partitioned by is not one of its columns
    return {n: df.select(*S.OUTPUT_SCHEMAS[n].names) for n, df in frames.items()}
