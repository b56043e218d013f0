"""Writers, SQL names and the output footprint report (IO5-IO7)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def output_path(out_dir: str, name: str) -> str:
    return os.path.join(out_dir, f"{name}.parquet")


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects, for the few operations that are not table reads or writes."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    file = jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(conf), file


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists in its file system; any other failure is raised."""
    fs, file = hadoop_fs(spark, path)
    return bool(fs.exists(file))


def write_output(
    df: DataFrame, out_dir: str, name: str, partition_by: list[str] | None = None
) -> str:
    """Write one output as Parquet, replacing an earlier run (IO5).

    The write is a job commit: tasks lost with an executor are retried and
    only committed files become visible.
    """
    path = output_path(out_dir, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose frames to SQL under the given names (IO6)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def output_footprint(spark: SparkSession, out_dir: str) -> DataFrame:
    """Bytes and megabytes taken by each output folder, plus a total row (IO7).

    A distributed listing: the ``binaryFile`` source lists the files and,
    with only ``path`` and ``length`` selected, never reads their content.
    Bookkeeping files (``_SUCCESS``, ``.crc``) are skipped. The total row
    has a null ``output``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(out_dir)
        .select(
            F.regexp_extract("path", r"/([^/]+)\.parquet/", 1).alias("output"),
            "length",
        )
    )
    return (
        files.rollup("output")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .select("output", "files", "bytes", (F.col("bytes") / (1024 * 1024)).alias("mb"))
    )
