"""The sixteen next-day observations: timestamps, scores, rule labels, serving."""

import datetime as dt

from pyspark.sql import functions as F

from emberline import reference_values as RV
from emberline.operators.enrich import engineer, label_rows
from emberline.operators.model import fixed_model, predict
from emberline.plans import serve as SV
from emberline.sources.observations import inline_observations

# station: (temp score, humidity score, rule label) -- expected values
EXPECTED = {
    "station_BY": (4, 4, "moderate"), "station_BW": (4, 4, "moderate"),
    "station_BB": (4, 3, "moderate"), "station_SN": (4, 3, "moderate"),
    "station_NW": (3, 3, "low"), "station_HE": (4, 3, "low"),
    "station_NI": (3, 2, "low"), "station_SH": (3, 2, "low"),
    "station_MV": (3, 2, "low"), "station_BE": (4, 3, "moderate"),
    "station_HH": (3, 2, "low"), "station_HB": (3, 2, "low"),
    "station_RP": (4, 3, "moderate"), "station_SL": (4, 3, "moderate"),
    "station_ST": (4, 3, "moderate"), "station_TH": (4, 3, "moderate"),
}


def test_inline_rows_timestamp_and_month(spark):
    rows = inline_observations(spark).collect()
    assert len(rows) == 16
    assert {r["timestamp"] for r in rows} == {dt.datetime(2025, 9, 18, 12, 0, 0)}
    assert {r["month"] for r in rows} == {9}
    assert [f.name for f in inline_observations(spark).schema][:3] == [
        "station_id", "state_province", "timestamp"]


def test_scores_and_rule_labels(spark):
    got = label_rows(engineer(inline_observations(spark))).collect()
    for r in got:
        assert (r["temp_risk_score"], r["humidity_risk_score"], r[RV.LABEL_COLUMN]) == \
            EXPECTED[r["station_id"]], r["station_id"]


def test_scoring_shape_and_probabilities(spark):
    preds = predict(fixed_model(), engineer(inline_observations(spark)))
    label = f"predicted_{RV.LABEL_COLUMN}"
    probs = f"{label}_probs"
    rows = preds.collect()
    assert len(rows) == 16
    for r in rows:
        ps = [e["prob"] for e in r[probs]]
        assert abs(sum(ps) - 1.0) < 1e-12
        assert ps == sorted(ps, reverse=True)
        assert r[probs][0]["label"] == r[label]
    # input columns pass through unchanged
    assert preds.columns[:13] == inline_observations(spark).columns


def test_serving_zero_as_null_and_iso_time(spark):
    preds = predict(fixed_model(), engineer(inline_observations(spark)))
    recs = SV.current_predictions(preds).collect()
    assert len(recs) == 16
    zero_precip = [r for r in recs if r["precipitation_mm"] is None]
    assert len(zero_precip) == 6
    assert {r["timestamp"] for r in recs} == {"2025-09-18T12:00:00"}
    probs = [r["risk_probability"] for r in recs]
    assert probs == sorted(probs, reverse=True)
    raw = SV.current_predictions(preds, zero_as_null=False).collect()
    assert sum(r["precipitation_mm"] == 0.0 for r in raw) == 6


def test_state_lookup_case_insensitive_and_missing(spark):
    preds = predict(fixed_model(), engineer(inline_observations(spark)))
    hit = SV.prediction_for_state(preds, "THÜRINGEN").collect()
    assert len(hit) == 1 and hit[0]["station_id"] == "station_TH"
    assert SV.prediction_for_state(preds, "Atlantis").count() == 0
    req = spark.createDataFrame([("bayern",), ("nowhere",)], "requested_state string")
    out = {r["requested_state"]: r for r in SV.lookup(req, preds).collect()}
    assert out["bayern"]["found"] and out["bayern"]["station_id"] == "station_BY"
    assert not out["nowhere"]["found"] and out["nowhere"]["station_id"] is None


def test_available_states_and_sample(spark):
    preds = predict(fixed_model(), engineer(inline_observations(spark)))
    rows = sorted(SV.available_states(preds).collect())
    assert [tuple(r) for r in rows] == [(i, s, 16) for i, s in enumerate(sorted(RV.STATES))]
    top = SV.sample_predictions(preds, 5).collect()
    assert len(top) == 5
    high = SV.sample_predictions(preds, 16, by="high_risk_prob").collect()
    assert [r.high_risk_prob for r in high] == sorted((r.high_risk_prob for r in high), reverse=True)
    label = "predicted_" + RV.LABEL_COLUMN
    assert all((r[label] == "high") == (r.high_risk_prob == r.high_risk_probability) for r in high)


def test_empty_table_everywhere(spark):
    from emberline.operators.evaluation import auc_by_class, confusion, macro_metrics
    empty = inline_observations(spark).limit(0)
    preds = predict(fixed_model(), engineer(empty))
    assert preds.count() == 0
    assert SV.current_predictions(preds).count() == 0
    assert SV.prediction_for_state(preds, "Bayern").count() == 0
    assert SV.available_states(preds).count() == 0
    label = f"predicted_{RV.LABEL_COLUMN}"
    assert confusion(preds, "state_province", label).count() == 0
    assert macro_metrics(confusion(preds, "state_province", label)).first()["accuracy"] is None
    scored = preds.select("state_province", F.lit(0.5).alias("p"))
    assert auc_by_class(scored, "state_province", {"x": "p"}).count() == 0


def test_available_states_keeps_a_null_region(spark):
    obs = inline_observations(spark)
    with_null = obs.unionByName(obs.limit(1).withColumn("state_province", F.lit(None).cast("string")))
    preds = predict(fixed_model(), engineer(with_null))
    rows = {r.state_index: r for r in SV.available_states(preds).collect()}
    assert len(rows) == 17 and rows[0]["state_province"] is None and rows[0]["n_states"] == 17
    assert [rows[i]["state_province"] for i in range(1, 17)] == sorted(RV.STATES)


def test_lookup_found_even_when_the_record_has_null_fields(spark):
    obs = inline_observations(spark).where(F.col("state_province") == "Berlin") \
        .withColumn("station_id", F.lit(None).cast("string"))
    preds = predict(fixed_model(), engineer(obs))
    req = spark.createDataFrame([("BERLIN",)], "requested_state string")
    r = SV.lookup(req, preds).first()
    assert r["found"] and r["station_id"] is None and r["state_province"] == "Berlin"


def test_inline_rows_match_duckdb(spark):
    """The inline table, its zoned timestamp, month and scores recomputed by DuckDB."""
    import duckdb

    from emberline.plans import oracle as O
    values = ", ".join(
        "(" + ", ".join(O.s(v) if isinstance(v, str) else O.d(v) for v in row) + ")"
        for row in RV.NEXT_DAY_OBSERVATIONS)
    cols = ", ".join(RV.OBSERVATION_COLUMNS)
    sql = f"""
    SELECT station_id, strftime(timezone('{RV.OBSERVATION_ZONE}',
                                timezone('UTC', TIMESTAMP '{RV.OBSERVATION_TIME}')), '%Y-%m-%dT%H:%M:%S') AS ts,
           CAST(month(timezone('{RV.OBSERVATION_ZONE}', timezone('UTC', TIMESTAMP '{RV.OBSERVATION_TIME}')))
                AS BIGINT) AS month,
           {O.temp_score()} AS temp_risk_score, {O.humidity_score()} AS humidity_risk_score,
           {O.rule_label()} AS label
    FROM (VALUES {values}) v({cols})
    """
    want = sorted(duckdb.sql(sql).fetchall())
    from emberline.functions.temporal import iso_datetime
    got = label_rows(engineer(inline_observations(spark))).select(
        "station_id", iso_datetime("timestamp").alias("ts"), "month", "temp_risk_score",
        "humidity_risk_score", RV.LABEL_COLUMN).collect()
    assert sorted(tuple(r) for r in got) == want
