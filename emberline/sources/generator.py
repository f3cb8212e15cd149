"""Synthetic training table: a range of row ids turned into columns.

Every value is a Spark expression of ``(seed, row_id)`` (see
``functions.rng``), so generation is a narrow, codegen'd projection over
``spark.range`` with no shuffle, and any partition can be recomputed alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from .. import reference_values as RV
from ..functions.sqltext import num
from ..functions.rng import cascade_sql, uniform_sql
from ..operators.enrich import coordinates_sql, derived_sql
from ..session import default_parallelism

ROWS_PER_PARTITION = 2_000_000


def base_columns_sql(seed, id_sql: str = "row_id") -> list[str]:
    """The synthetic columns, in table order, as Spark SQL text (one parse and one analysis)."""
    cols = []
    for name, (scale, offset) in RV.NUMERIC_DRAWS.items():
        cols.append(f"{uniform_sql(seed, name, id_sql)} * {num(scale)} + {num(offset)} AS {name}")
    cols.append(f"concat('station_', CAST(CAST(FLOOR({uniform_sql(seed, 'station_id', id_sql)} * "
                f"{num(RV.STATION_COUNT)}) + 1 AS BIGINT) AS STRING)) AS station_id")
    scale, offset = RV.ELEVATION_DRAW
    cols.append(f"{uniform_sql(seed, 'elevation_meters', id_sql)} * {num(scale)} + {num(offset)} "
                f"AS elevation_meters")
    cols.append(f"{cascade_sql(seed, 'weather', id_sql, RV.WEATHER_LABELS, RV.WEATHER_THRESHOLDS)} "
                f"AS weather_condition")
    cols.append(f"{cascade_sql(seed, 'state', id_sql, RV.STATES, RV.STATE_THRESHOLDS)} AS state_province")
    cols.append(f"CAST(FLOOR({uniform_sql(seed, 'month', id_sql)} * {num(RV.MONTH_COUNT)}) + 1 AS BIGINT) "
                f"AS month")
    return cols


def id_range(spark: SparkSession, n: int, num_partitions: int | None = None,
             rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Ids 1..n as ``row_id``; by default one partition per ``rows_per_partition``
    ids (never fewer partitions than the cluster has cores)."""
    if num_partitions is None:
        num_partitions = max(default_parallelism(spark),
                             math.ceil(n / max(1, rows_per_partition)))
    return spark.range(1, n + 1, numPartitions=num_partitions).withColumnRenamed("id", "row_id")


def synthetic_rows(ids: DataFrame, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """Base draws for every id of ``ids`` (before coordinates and labels)."""
    return ids.selectExpr(f"`{id_col}` AS row_id", *base_columns_sql(seed, f"`{id_col}`"))


def generate_training(spark: SparkSession, n: int = RV.DEFAULT_TRAINING_ROWS,
                      seed: int = 42, num_partitions: int | None = None,
                      rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """The full 18-column training table for ids 1..n (identical for any partitioning)."""
    return training_from_ids(id_range(spark, n, num_partitions, rows_per_partition), seed)


def training_from_ids(ids: DataFrame, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """Base draws, then coordinates, risk scores and the rule label in one projection."""
    base = synthetic_rows(ids, seed, id_col)
    return base.selectExpr("*", *coordinates_sql(seed, "row_id"), *derived_sql())
