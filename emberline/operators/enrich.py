"""Row-wise enrichment: coordinates, risk scores, rule labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference_values as RV
from ..functions.rng import uniform
from ..functions.sqltext import num, text
from ..functions.scores import humidity_risk_score, temp_risk_score, wildfire_rule_label


def _literal_map(entries: dict, position: int) -> Column:
    return F.create_map(*chain.from_iterable(
        (F.lit(k), F.lit(float(v[position]))) for k, v in entries.items()))


def _jitter(center: Column, spread: Column, u: Column) -> Column:
    return center + (u - F.lit(0.5)) * spread


def enrich_coordinates(df: DataFrame, seed: int = 42, id_col: str = "row_id",
                       state_col: str = "state_province", centroids=None,
                       default=RV.DEFAULT_CENTROID) -> DataFrame:
    """Append ``longitude``/``latitude``: state centroid plus seeded jitter.

    ``centroids`` may be a dict ``state -> (lon, lon_spread, lat, lat_spread)``
    (default: the sixteen states), compiled into literal maps inside the
    projection -- a lookup with no join and no shuffle -- or a DataFrame with
    columns ``state_province, lon, lon_spread, lat, lat_spread``, joined on the
    state; adaptive execution picks the join on measured sizes.  A state listed
    twice takes its smallest entry, so no row is multiplied.  Unknown and NULL
    states take ``default``.
    """
    rid = F.col(id_col)
    u_lon = uniform(seed, "longitude", rid)
    u_lat = uniform(seed, "latitude", rid)
    d_lon, d_lon_s, d_lat, d_lat_s = (F.lit(float(x)) for x in default)
    if centroids is None or isinstance(centroids, dict):
        table = RV.CENTROIDS if centroids is None else centroids
        state = F.col(state_col)
        look = lambda pos: F.try_element_at(_literal_map(table, pos), state)
        lon = _jitter(F.coalesce(look(0), d_lon), F.coalesce(look(1), d_lon_s), u_lon)
        lat = _jitter(F.coalesce(look(2), d_lat), F.coalesce(look(3), d_lat_s), u_lat)
        return df.withColumns({"longitude": lon, "latitude": lat})
    entry = F.min(F.struct("lon", "lon_spread", "lat", "lat_spread")).alias("c")
    c = centroids.groupBy(F.col("state_province").alias("_c_state")).agg(entry).select(
        "_c_state", F.col("c.lon").alias("_c_lon"), F.col("c.lon_spread").alias("_c_lon_s"),
        F.col("c.lat").alias("_c_lat"), F.col("c.lat_spread").alias("_c_lat_s"))
    joined = df.join(c, F.col(state_col) == F.col("_c_state"), "left")
    lon = _jitter(F.coalesce("_c_lon", d_lon), F.coalesce("_c_lon_s", d_lon_s), u_lon)
    lat = _jitter(F.coalesce("_c_lat", d_lat), F.coalesce("_c_lat_s", d_lat_s), u_lat)
    return (joined.withColumns({"longitude": lon, "latitude": lat})
            .drop("_c_state", "_c_lon", "_c_lon_s", "_c_lat", "_c_lat_s"))


def coordinates_sql(seed: int = 42, id_sql: str = "row_id", state_sql: str = "state_province",
                    centroids: dict | None = None, default=RV.DEFAULT_CENTROID) -> list[str]:
    """``enrich_coordinates`` (literal-map form) as Spark SQL text."""
    from ..functions.rng import uniform_sql
    table = RV.CENTROIDS if centroids is None else centroids

    def look(pos):
        entries = ", ".join(f"{text(k)}, {num(v[pos])}" for k, v in table.items())
        return f"coalesce(try_element_at(map({entries}), {state_sql}), {num(default[pos])})"

    lon = f"{look(0)} + ({uniform_sql(seed, 'longitude', id_sql)} - {num(0.5)}) * {look(1)}"
    lat = f"{look(2)} + ({uniform_sql(seed, 'latitude', id_sql)} - {num(0.5)}) * {look(3)}"
    return [f"{lon} AS longitude", f"{lat} AS latitude"]


def derived_sql() -> list[str]:
    """Risk scores and the rule label as Spark SQL text (same CASEs as the Column form)."""
    (t1, s1), (t2, s2) = RV.TEMP_SCORE_CUTS
    (h1, g1), (h2, g2) = RV.HUMIDITY_SCORE_CUTS
    hi, mo = RV.HIGH_RULE, RV.MODERATE_RULE
    return [
        f"CASE WHEN temperature_celsius > {num(t1)} THEN CAST({s1} AS BIGINT) "
        f"WHEN temperature_celsius > {num(t2)} THEN CAST({s2} AS BIGINT) "
        f"ELSE CAST({RV.TEMP_SCORE_DEFAULT} AS BIGINT) END AS temp_risk_score",
        f"CASE WHEN humidity_percent < {num(h1)} THEN CAST({g1} AS BIGINT) "
        f"WHEN humidity_percent < {num(h2)} THEN CAST({g2} AS BIGINT) "
        f"ELSE CAST({RV.HUMIDITY_SCORE_DEFAULT} AS BIGINT) END AS humidity_risk_score",
        f"CASE WHEN temperature_celsius > {num(hi['temperature_gt'])} "
        f"AND humidity_percent < {num(hi['humidity_lt'])} AND wind_speed_ms > {num(hi['wind_gt'])} "
        f"THEN 'high' WHEN temperature_celsius > {num(mo['temperature_gt'])} "
        f"AND humidity_percent < {num(mo['humidity_lt'])} THEN 'moderate' ELSE 'low' END "
        f"AS {RV.LABEL_COLUMN}",
    ]


def centroid_table(spark) -> DataFrame:
    rows = [(k, *v) for k, v in RV.CENTROIDS.items()]
    return spark.createDataFrame(
        rows, "state_province string, lon double, lon_spread double, lat double, lat_spread double")


def engineer(df: DataFrame, temperature="temperature_celsius",
             humidity="humidity_percent") -> DataFrame:
    """All input columns plus ``temp_risk_score`` and ``humidity_risk_score``."""
    if temperature == "temperature_celsius" and humidity == "humidity_percent":
        return df.selectExpr("*", *derived_sql()[:2])
    return df.withColumns({
        "temp_risk_score": temp_risk_score(temperature),
        "humidity_risk_score": humidity_risk_score(humidity),
    })


def label_rows(df: DataFrame, label_col: str = RV.LABEL_COLUMN) -> DataFrame:
    """All input columns plus the rule label high / moderate / low."""
    if label_col == RV.LABEL_COLUMN:
        return df.selectExpr("*", derived_sql()[2])
    return df.withColumn(label_col, wildfire_rule_label())
