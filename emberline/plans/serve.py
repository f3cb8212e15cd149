"""Read-side queries over a stored predictions table.

Each returns a DataFrame (records are rows, not driver-side dicts): the
ranked list, the lookup of one region or of a batch of requested regions, the
available regions, model metadata, top-k samples and the run summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import reference_values as RV
from ..functions.temporal import iso_datetime, iso_instant
from ..operators.model import first_of, prob_of, top_of
from ..operators.ranking import read_ranked, store_ranked
from ..operators.row_id import with_row_id
from ..session import scratch_path, stored

PRED = f"predicted_{RV.LABEL_COLUMN}"
REGION_KEY = "state_key"      # partition column of a stored predictions table
PROBS = f"predicted_{RV.LABEL_COLUMN}_probs"
PLAIN = "prob_"               # columns of single classes, where a frame has them
HIGH = "high"                 # the class whose probability readers ask for

SERVING_COLUMNS = ["station_id", "state_province", "temperature_celsius", "humidity_percent",
                   "wind_speed_ms", "precipitation_mm", "weather_condition"]
# a total order over the projected record, used wherever "first row" matters
RECORD_ORDER = ["station_id", "state_province", "timestamp", "temperature_celsius",
                "humidity_percent", "wind_speed_ms", "precipitation_mm", "weather_condition"]
# the remaining projected fields, so that "first" is a total order on records
TIE_BREAK = [PRED, "high_risk_label", "high_risk_probability", "high_class_probability"]


def _zero_null(c: str, zero_as_null: bool) -> Column:
    x = F.col(c).cast("double")
    return F.nullif(x, F.lit(0.0)).alias(c) if zero_as_null else x.alias(c)


def first_and_high(preds: DataFrame) -> tuple[Column, Column, Column]:
    """First label and probability of the array, and the probability of ``HIGH``: from plain
    ``prob_<class>`` columns if ``preds`` has them, else from the array."""
    classes = [c[len(PLAIN):] for c in preds.columns if c.startswith(PLAIN)]
    if HIGH in classes:
        return (*top_of(classes, PLAIN), F.col(PLAIN + HIGH))
    return first_of(PROBS, "label"), first_of(PROBS, "prob"), prob_of(PROBS, HIGH)


def prediction_rows(preds: DataFrame) -> DataFrame:
    """The projected fields: inputs, predicted label, first (label, prob) of the array."""
    label, prob, high = first_and_high(preds)
    return preds.select(*SERVING_COLUMNS, PRED, label.alias("high_risk_label"), prob.alias("high_risk_probability"),
                        high.alias("high_class_probability"), "timestamp")


def as_records(rows: DataFrame, zero_as_null: bool = True) -> DataFrame:
    """Rename and coerce into the served record shape.

    ``zero_as_null`` reproduces the served behaviour that a 0.0 measurement
    (and a 0.0 probability) is reported as missing.
    """
    return rows.select(*as_records_columns(zero_as_null))


def ranking_order(digits: int | None = None) -> list[Column]:
    p = F.col("high_risk_probability")
    p = p if digits is None else F.round(p, digits)
    return [F.desc(p), *[F.asc(c) for c in RECORD_ORDER + TIE_BREAK]]


def save_ranked_predictions(preds: DataFrame, path: str, digits: int | None = None) -> None:
    """Store the prediction rows in rank order under ``path``: highest first-element
    probability first (compared to ``digits`` places if given), ties by ``RECORD_ORDER``.

    The rows are scored once: their narrow records are stored before they are sorted.
    """
    rows = stored(prediction_rows(preds), "records")
    store_ranked(rows, ranking_order(digits), path)


def ranked_predictions(spark: SparkSession, path: str, first: int | None = None, last: int | None = None,
                       zero_as_null: bool = True) -> DataFrame:
    """Records stored by ``save_ranked_predictions`` with ``rank_position``; a page of ranks
    reads only the files that hold it."""
    return read_ranked(spark, path, first, last).select("rank_position", *as_records_columns(zero_as_null))


def current_predictions(preds: DataFrame, zero_as_null: bool = True, digits: int | None = None) -> DataFrame:
    """All predictions with ``rank_position``: highest first-element probability first.

    The order is a column, so it survives whatever is done with the rows.  They are
    stored in rank order when this is called, in the shared checkpoint folder, and
    show ``preds`` as it is then.
    """
    path = scratch_path(preds.sparkSession, "ranked")
    save_ranked_predictions(preds, path, digits)
    return ranked_predictions(preds.sparkSession, path, zero_as_null=zero_as_null)


def prediction_for_state(preds: DataFrame, state: str, zero_as_null: bool = True) -> DataFrame:
    """The first prediction of one region, matched case-insensitively; empty if none.

    The region is a bound parameter compared as ``lower(col) = lower(:p)``;
    "first" is the smallest record in ``RECORD_ORDER`` (a per-partition top-1
    then a merge, no full sort).  On a table stored with ``save_predictions``
    the same condition on the ``state_key`` partition column prunes the scan
    to one region's files.
    """
    wanted = F.lower(F.lit(state))
    if REGION_KEY in preds.columns:
        # stored partitioned by lower(region): this becomes a partition filter
        preds = preds.where(F.col(REGION_KEY) == wanted)
    hit = prediction_rows(preds).where(F.lower(F.col("state_province")) == wanted)
    first = hit.orderBy(*[F.asc(c) for c in RECORD_ORDER + TIE_BREAK]).limit(1)
    return as_records(first, zero_as_null)


def first_rows(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each ``key`` in ``order`` (NULL first, NaN last).

    A minimum over the whole record: each task hands on one row for every key it
    meets, so a key with a third of all rows leaves its map tasks as one row each.
    """
    return rows.groupBy(key).agg(F.min(F.struct(*order)).alias("_rec")).select(key, "_rec.*")


def first_per_state(preds: DataFrame) -> DataFrame:
    """``(state_key, rec)``: the smallest record per lower-cased region."""
    order = RECORD_ORDER + TIE_BREAK
    rows = prediction_rows(preds).select(F.lower("state_province").alias("state_key"), *order)
    return first_rows(rows, "state_key", order).select("state_key", F.struct(*order).alias("rec"))


def lookup(requests: DataFrame, preds: DataFrame, request_col: str = "requested_state",
           zero_as_null: bool = True) -> DataFrame:
    """Batch lookup: every request row, ``found`` flag, and its region's first record.

    The per-region table has one row per distinct region; adaptive execution
    broadcasts it when its measured size is small and falls back to a
    sort-merge join otherwise.
    """
    firsts = first_per_state(preds)
    joined = requests.join(firsts, F.lower(F.col(request_col)) == F.col("state_key"), "left")
    # found = the join matched (a matched record may itself hold NULL fields)
    rec = joined.select(request_col, F.col("state_key").isNotNull().alias("found"), F.col("rec.*"))
    return rec.select(request_col, "found", *as_records_columns(zero_as_null))


def lookup_saved(requests: DataFrame, stored_preds: DataFrame, request_col: str = "requested_state",
                 zero_as_null: bool = True) -> DataFrame:
    """``lookup`` over a table stored by region (``catalog.save_predictions``).

    The requested regions are joined on the partition column first, so their keys
    prune the scan at run time: only the folders of regions that somebody asks for
    are read.  A blank request matches no stored region.
    """
    asked = requests.select(F.lower(F.col(request_col)).alias("_asked")).where(F.length("_asked") > 0).distinct()
    wanted = stored_preds.join(asked, F.col(REGION_KEY) == F.col("_asked")).drop("_asked")
    return lookup(requests, wanted, request_col, zero_as_null)


def as_records_columns(zero_as_null: bool) -> list[Column]:
    return [
        F.col("station_id"), F.col("state_province"),
        _zero_null("temperature_celsius", zero_as_null),
        _zero_null("humidity_percent", zero_as_null),
        _zero_null("wind_speed_ms", zero_as_null),
        _zero_null("precipitation_mm", zero_as_null),
        F.col("weather_condition"),
        F.col(PRED).alias("predicted_risk_level"),
        _zero_null("high_risk_probability", zero_as_null).alias("risk_probability"),
        F.col("high_class_probability").alias("high_risk_prob"),
        iso_datetime("timestamp").alias("timestamp"),
    ]


def available_states(preds: DataFrame, col: str = "state_province") -> DataFrame:
    """``(state_index, state_province, n_states)``: the distinct regions in order, NULL first.

    One row per region however many there are: the distinct and the numbering
    both run distributed.
    """
    distinct = preds.select(F.col(col).alias("state_province")).distinct()
    return with_row_id(distinct, ["state_province"], name="_n", total="n_states").select(
        (F.col("_n") - 1).cast("int").alias("state_index"), "state_province", "n_states")


def sample_predictions(preds: DataFrame, k: int = 5, by: str = "high_risk_probability") -> DataFrame:
    """Top-k by first-element probability, or ``by="high_risk_prob"`` by that of the
    class "high" (per-partition top-k, then a merge)."""
    _, prob, high = first_and_high(preds)
    rows = preds.select("station_id", "state_province", "temperature_celsius", "humidity_percent",
                        PRED, prob.alias("high_risk_probability"), high.alias("high_risk_prob"),
                        "timestamp", "precipitation_mm", "wind_speed_ms", "weather_condition")
    ordered = rows.orderBy(F.desc(by), *[F.asc(c) for c in RECORD_ORDER + [PRED]]).limit(k)
    return ordered.select("station_id", "state_province", "temperature_celsius",
                          "humidity_percent", PRED, "high_risk_probability", "high_risk_prob")


def sample_rows(df: DataFrame, order_by: Sequence[str], k: int = 10) -> DataFrame:
    """``LIMIT k`` under a total order (a plain LIMIT would be arbitrary)."""
    return df.orderBy(*[F.asc(c) for c in order_by]).limit(k)


def model_info(registry: DataFrame, name: str) -> DataFrame:
    """The registry row of ``name``; empty when it is not registered."""
    hit = registry.where(F.col("model_name") == F.lit(name))
    return hit.select("model_catalog", "model_schema", "model_name", "model_type",
                      iso_instant("creation_time").alias("creation_time"),
                      iso_instant("last_modified_time").alias("last_modified_time"))


def model_info_batch(registry: DataFrame, requests: DataFrame, request_col: str = "model_name") -> DataFrame:
    """One row per request, one schema: the registry row, or only the name and an ``error``."""
    info = registry.select(
        "model_catalog", "model_schema", F.col("model_name").alias("_found"), "model_type",
        iso_instant("creation_time").alias("creation_time"), iso_instant("last_modified_time").alias("last_modified_time"),
        "version", "classes")
    joined = requests.select(F.col(request_col).alias("model_name")).join(info, F.col("model_name") == F.col("_found"), "left")
    return joined.select("model_catalog", "model_schema", "model_name", "model_type", "creation_time", "last_modified_time",
                         "version", "classes", F.when(F.col("_found").isNull(), F.lit("Model not found")).alias("error"))


def model_info_or_error(registry: DataFrame, name: str) -> DataFrame:
    return model_info_batch(registry, registry.sparkSession.range(1).select(F.lit(name).alias("model_name")))


def summary_rows(training: DataFrame, predictions: DataFrame,
                 metrics: dict[str, DataFrame] | None = None) -> DataFrame:
    """``(metric, value)``: row counts, then each named one-row metric ("N/A" if NULL).

    Each figure is its own one-row aggregate; a UNION keeps them as separate
    rows, so no join of single-row frames is needed.
    """
    parts = [
        training.agg(F.lit("training_rows").alias("metric"),
                     F.count(F.lit(1)).cast("string").alias("value")),
        predictions.agg(F.lit("prediction_rows").alias("metric"),
                        F.count(F.lit(1)).cast("string").alias("value")),
    ]
    for name, frame in (metrics or {}).items():
        col = frame.columns[0]
        parts.append(frame.select(F.lit(name).alias("metric"),
                                  F.coalesce(F.col(col).cast("string"), F.lit("N/A")).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
