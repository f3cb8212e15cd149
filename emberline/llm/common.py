"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, scratch_path
from ..sources.tables import read_table

# a word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder.

    Cuts the lineage: what was written survives the loss of any executor.
    """
    return Tables(df.sparkSession).written(df, tag)


class Tables:
    """Written tables of one computation, to be deleted once nothing reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, tag: str) -> DataFrame:
        path = scratch_path(self.spark, tag)
        df.write.option("compression", "zstd").parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self, but_last: int = 0) -> None:
        """Delete the tables written so far, except the last ``but_last``."""
        at = len(self.paths) - but_last
        for path in self.paths[:max(0, at)]:
            discard(self.spark, path)
        self.paths = self.paths[max(0, at):]


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``ARROW_ROWS`` rows: texts are wide, and a batch
    of long ones must fit a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def n_words(text: Column) -> Column:
    """Number of words of a text (NULL: 0), as a native expression."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.filter(parts, lambda w: w != "")).cast("long")


def as_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (NULL: none), ready for Arrow without a decode."""
    return F.coalesce(text, F.lit("")).cast("binary")
