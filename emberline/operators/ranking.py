"""Rows stored in a global order, with their ranks.

The rows are written sorted, one range of the order in each file.  A manifest
beside them has the number of rows of each file and of all files before it, so
a row's rank is that number plus its place in the file, which the reader knows.
Nothing is cached, sorted again or numbered in one task, and a page of ranks
reads only the files that hold it.

Layout under the given path: ``rows/`` and ``manifest/`` (file, part, n, before).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANK = "rank_position"


def store_ranked(df: DataFrame, order: list, path: str) -> None:
    """Write ``df`` in ``order``, then its manifest.  ``path`` must not exist.

    Finding the ranges reads ``df`` twice; store it first if it is dear to compute.
    """
    spark = df.sparkSession
    df.orderBy(*order).write.parquet(f"{path}/rows")
    # the count of rows of a file needs no column of it
    files = spark.read.schema(df.schema).parquet(f"{path}/rows").select(
        F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    # files are named by the number of their range, then by their number in it
    part = F.array(*[F.regexp_extract("file", pattern, 1).cast("long") for pattern in (r"part-(\d+)", r"c(\d+)\.[^-]*$")])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files.withColumn("part", part).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select(
        "file", "part", "n", "before").coalesce(1).write.parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string, part array<bigint>, n long, before long").parquet(f"{path}/manifest")


def read_ranked(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, name: str = RANK) -> DataFrame:
    """The stored rows with their 1-based rank; from rank ``first`` to ``last`` if given,
    reading no file that lies outside."""
    files = manifest(spark, path)
    rows = spark.read.schema(_schema(spark, path))
    if first is None and last is None:
        rows = rows.parquet(f"{path}/rows")
    else:
        first, last = first or 1, 2 ** 63 - 1 if last is None else last
        files = files.where((F.col("before") < last) & (F.col("before") + F.col("n") >= first))
        own = [f"{path}/rows/{r.file}" for r in files.select("file").collect()]  # of the page only
        rows = rows.parquet(*own) if own else spark.createDataFrame([], _schema(spark, path)).select(
            "*", F.struct(F.lit("").alias("file_name"), F.lit(0).cast("long").alias("row_index")).alias("_metadata"))
    placed = rows.select("*", F.col("_metadata.file_name").alias("_rk_file"), F.col("_metadata.row_index").alias("_rk_at"))
    starts = files.select(F.col("file").alias("_rk_file"), F.col("before").alias("_rk_before"))
    out = placed.join(F.broadcast(starts), "_rk_file").withColumn(name, F.col("_rk_before") + F.col("_rk_at") + 1)
    out = out.drop("_rk_file", "_rk_at", "_rk_before")
    return out if first is None and last is None else out.where(F.col(name).between(first, last))


def _schema(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/rows").schema
