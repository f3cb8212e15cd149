"""Observation tables to score.

``inline_observations`` is the sixteen-row next-day table; ``from_lineitem``
derives an observation table of any size from the ``lineitem`` table with a
narrow projection (no shuffle), so scoring and serving grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import reference_values as RV
from ..functions.sqltext import text
from ..functions.temporal import month_of, zoned_wall_time

OBSERVATION_SCHEMA = (
    "station_id string, state_province string, temperature_celsius double, "
    "humidity_percent double, pressure_hpa double, wind_speed_ms double, "
    "wind_direction_degrees double, precipitation_mm double, visibility_km double, "
    "weather_condition string, elevation_meters double"
)

OBSERVATION_ORDER = [
    "station_id", "state_province", "timestamp", "temperature_celsius",
    "humidity_percent", "pressure_hpa", "wind_speed_ms", "wind_direction_degrees",
    "precipitation_mm", "visibility_km", "weather_condition", "elevation_meters", "month",
]


def inline_observations(spark: SparkSession, rows=None, at: str = RV.OBSERVATION_TIME,
                        zone: str = RV.OBSERVATION_ZONE) -> DataFrame:
    """The next-day observation rows with their timestamp and month."""
    rows = RV.NEXT_DAY_OBSERVATIONS if rows is None else rows
    df = spark.createDataFrame(list(rows), OBSERVATION_SCHEMA)
    ts = zoned_wall_time(F.lit(at).cast("timestamp_ntz"), zone)
    return df.withColumns({"timestamp": ts, "month": month_of(ts)}).select(*OBSERVATION_ORDER)


ROW_KEY = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id"


def from_lineitem(lineitem: DataFrame, keyed: bool = False) -> DataFrame:
    """Weather-like observations, one per lineitem row.

    Every column is a deterministic function of the row's keys and measures
    (quantity -> temperature, discount -> humidity, tax -> wind, price ->
    precipitation, ...), the state is ``suppkey mod 16`` into the state list
    and the weather label ``partkey mod 5`` into the weather list.  The first
    line of each order reports zero precipitation.  ``keyed`` adds ``row_id``,
    the text of the row's keys, by which draws and splits are made.
    """
    states = ", ".join(text(x) for x in RV.STATES)
    weather = ", ".join(text(x) for x in RV.WEATHER_LABELS)
    return lineitem.selectExpr(
        *([ROW_KEY] if keyed else []),
        "concat('station_', CAST(l_suppkey % 16 + 1 AS STRING)) AS station_id",
        f"element_at(array({states}), CAST(l_suppkey % 16 + 1 AS INT)) AS state_province",
        "l_shipdate AS timestamp",
        "10.0D + l_quantity / 2.0D AS temperature_celsius",
        "20.0D + l_discount * 700.0D AS humidity_percent",
        "990.0D + (l_partkey % 200) / 10.0D AS pressure_hpa",
        "l_tax * 187.5D AS wind_speed_ms",
        "CAST(l_orderkey % 360 AS DOUBLE) AS wind_direction_degrees",
        "CASE WHEN l_linenumber = 1 THEN 0.0D ELSE l_extendedprice / 21000.0D END AS precipitation_mm",
        "CAST(l_orderkey % 100 AS DOUBLE) / 10.0D AS visibility_km",
        f"element_at(array({weather}), CAST(l_partkey % 5 + 1 AS INT)) AS weather_condition",
        "50.0D + CAST(l_partkey % 1500 AS DOUBLE) AS elevation_meters",
        "CAST(month(l_shipdate) AS BIGINT) AS month",
    )
