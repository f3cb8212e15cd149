"""Boundaries, invariance, AUC against brute force, row numbering, training."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline import reference_values as RV
from emberline.functions.rng import uniform
from emberline.functions.scores import humidity_risk_score, temp_risk_score, wildfire_rule_label
from emberline.operators.enrich import enrich_coordinates
from emberline.operators.evaluation import auc_by_class, roc_auc
from emberline.operators.model import fixed_model, predict
from emberline.operators.row_id import with_row_id
from emberline.operators.train import TrainConfig, split, train_gd
from emberline.sources.generator import generate_training


def test_threshold_boundaries(spark):
    df = spark.createDataFrame([(20.0, 40.0), (20.0001, 39.999), (25.0, 60.0), (25.5, 59.0),
                                (None, None)], "t double, h double")
    got = df.select(temp_risk_score("t").alias("ts"), humidity_risk_score("h").alias("hs")).collect()
    assert [(r.ts, r.hs) for r in got] == [(2, 3), (3, 4), (3, 2), (4, 3), (2, 2)]


def test_rule_label_boundaries(spark):
    df = spark.createDataFrame([
        (30.0, 20.0, 12.0), (30.1, 29.9, 10.1), (30.1, 29.9, 10.0), (25.0, 10.0, 0.0),
        (25.1, 49.9, 0.0), (25.1, 50.0, 0.0), (None, 10.0, 20.0)],
        "temperature_celsius double, humidity_percent double, wind_speed_ms double")
    got = [r[0] for r in df.select(wildfire_rule_label()).collect()]
    assert got == ["moderate", "high", "moderate", "low", "moderate", "low", "low"]


def test_uniform_is_partition_independent(spark):
    a = spark.range(0, 2000, numPartitions=1).select("id", uniform(7, "x", "id").alias("u"))
    b = spark.range(0, 2000, numPartitions=13).select("id", uniform(7, "x", "id").alias("u"))
    ra = {r.id: r.u for r in a.collect()}
    rb = {r.id: r.u for r in b.collect()}
    assert ra == rb
    assert all(0.0 <= v < 1.0 for v in ra.values())
    c = {r.id: r.u for r in spark.range(0, 2000).select("id", uniform(7, "y", "id").alias("u")).collect()}
    assert sum(ra[i] == c[i] for i in ra) == 0


def test_generator_invariant_and_cascade_frequencies(spark):
    g1 = generate_training(spark, 20000, seed=3, num_partitions=1)
    g8 = generate_training(spark, 20000, seed=3, num_partitions=8)
    assert g1.exceptAll(g8).count() == 0 and g8.exceptAll(g1).count() == 0
    n = 20000
    weather = {r[0]: r[1] / n for r in g8.groupBy("weather_condition").count().collect()}
    expect, rest = {}, 1.0
    for lab, t in zip(RV.WEATHER_LABELS, RV.WEATHER_THRESHOLDS + [1.0]):
        expect[lab] = rest * t
        rest *= 1 - t
    for lab, p in expect.items():
        assert abs(weather.get(lab, 0.0) - p) < 0.015, (lab, weather.get(lab), p)
    states = {r[0]: r[1] / n for r in g8.groupBy("state_province").count().collect()}
    assert abs(states["Baden-Württemberg"] - 0.0625) < 0.01
    assert abs(states["Mecklenburg-Vorpommern"] - 0.5 * np.prod([1 - t for t in RV.STATE_THRESHOLDS[:7]])) < 0.012
    assert g8.select(F.min("row_id"), F.max("row_id"), F.countDistinct("row_id")).first() == (1, n, n)


def test_coordinates_default_for_unknown_state(spark):
    df = spark.createDataFrame([(1, "Atlantis"), (2, None), (3, "Berlin")], "row_id long, state_province string")
    rows = {r.row_id: r for r in enrich_coordinates(df, seed=1).collect()}
    for rid in (1, 2):
        assert 9.0 <= rows[rid].longitude <= 11.0 and 50.0 <= rows[rid].latitude <= 52.0
    assert 13.15 <= rows[3].longitude <= 13.65 and 52.35 <= rows[3].latitude <= 52.65
    # a centroid table joined instead of the literal lookup gives the same values
    from emberline.operators.enrich import centroid_table
    via_join = {r.row_id: r for r in enrich_coordinates(df, seed=1, centroids=centroid_table(spark)).collect()}
    for rid in rows:
        assert (via_join[rid].longitude, via_join[rid].latitude) == (rows[rid].longitude, rows[rid].latitude)


def _brute_auc(y, s):
    pos = [v for t, v in zip(y, s) if t]
    neg = [v for t, v in zip(y, s) if not t]
    if not pos or not neg:
        return None
    won = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg))
    return won / (len(pos) * len(neg))


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_auc_matches_brute_force_with_ties(spark, parts):
    rng = np.random.RandomState(parts)
    n = 400
    labels = rng.choice(["a", "b", "c"], size=n, p=[0.2, 0.3, 0.5])
    sa = np.round(rng.rand(n), 2)          # rounding forces many ties
    sb = np.round(rng.rand(n), 1)
    sc = np.where(labels == "c", 0.7, 0.3)  # one score holds most rows
    rows = [(str(l), float(a), float(b), float(c)) for l, a, b, c in zip(labels, sa, sb, sc)]
    df = spark.createDataFrame(rows, "y string, pa double, pb double, pc double")
    cols = {"a": "pa", "b": "pb", "c": "pc"}
    got = {r.cls: r.auc for r in auc_by_class(df, "y", cols, num_partitions=parts).collect()}
    for cls, col, s in (("a", "pa", sa), ("b", "pb", sb), ("c", "pc", sc)):
        assert got[cls] == pytest.approx(_brute_auc(labels == cls, s), abs=1e-12)
    macro = roc_auc(df, "y", cols, num_partitions=parts).first()[0]
    assert macro == pytest.approx(np.mean([got[c] for c in "abc"]), abs=1e-12)


def test_auc_undefined_class(spark):
    df = spark.createDataFrame([("a", 0.9), ("a", 0.1)], "y string, pa double")
    r = auc_by_class(df, "y", {"a": "pa"}).first()
    assert r.auc is None and r.n_pos == 2 and r.n_neg == 0


def test_row_id_matches_global_order(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") * 7919 % 5000).alias("k"), F.col("id").alias("v"))
    got = with_row_id(df, ["k"], num_partitions=5)
    rows = got.collect()
    assert sorted(r.row_id for r in rows) == list(range(1, 5001))
    assert all(r.row_id == r.k + 1 for r in rows)


def test_gradient_descent_decreases_objective(spark):
    data = generate_training(spark, 3000, seed=5)
    train, held = split(data)
    cfg = TrainConfig(iterations=8)
    m = train_gd(train, cfg)
    assert len(m.history) == 8
    assert all(b <= a + 1e-12 for a, b in zip(m.history, m.history[1:]))
    scored = predict(m, held)
    label = f"predicted_{RV.LABEL_COLUMN}"
    assert scored.where(F.col(label).isNull()).count() == 0
    sql_cfg = TrainConfig(iterations=3, engine="sql")
    arrow_cfg = TrainConfig(iterations=3)
    a = train_gd(train, sql_cfg)
    b = train_gd(train, arrow_cfg)
    assert np.allclose(a.weights, b.weights, atol=1e-9) and np.allclose(a.intercepts, b.intercepts, atol=1e-9)


def test_unseen_category_scores_without_error(spark):
    df = spark.createDataFrame(
        [("station_X", "Atlantis", 30.0, 20.0, 1000.0, 5.0, 100.0, 0.0, 5.0, "hail", 300.0, 7, 4, 4)],
        "station_id string, state_province string, temperature_celsius double, humidity_percent double, "
        "pressure_hpa double, wind_speed_ms double, wind_direction_degrees double, precipitation_mm double, "
        "visibility_km double, weather_condition string, elevation_meters double, month long, "
        "temp_risk_score long, humidity_risk_score long")
    r = predict(fixed_model(), df).first()
    assert abs(sum(e["prob"] for e in r[f"predicted_{RV.LABEL_COLUMN}_probs"]) - 1.0) < 1e-12


def test_early_stop_is_opt_in(spark):
    data = generate_training(spark, 1500, seed=8)
    train, _ = split(data)
    full = train_gd(train, TrainConfig(iterations=12))
    early = train_gd(train, TrainConfig(iterations=12, early_stop=True, min_rel_progress=0.04))
    assert len(full.history) == 12
    assert 2 <= len(early.history) < 12
    rel = [(a - b) / a for a, b in zip(early.history, early.history[1:])]
    assert rel[-1] < 0.04 and all(r >= 0.04 for r in rel[:-1])


def test_row_id_splits_a_hot_tie_group(spark):
    # a third of the rows share one key value
    df = spark.range(0, 3000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = with_row_id(df, ["k"], num_partitions=6)
    rows = got.collect()
    assert sorted(r.row_id for r in rows) == list(range(1, 3001))
    ordered = sorted(rows, key=lambda r: r.row_id)
    assert [(r.k, r.v) for r in ordered] == sorted((r.k, r.v) for r in rows)
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1000   # the 1000-row tie group is split


def test_vocabulary_numbers_many_levels(spark):
    from emberline.operators.train import vocabulary
    df = spark.range(0, 20000, numPartitions=6).select(
        F.format_string("lv%05d", F.col("id") % 5000).alias("big"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("small"))
    got = vocabulary(df, ["big", "small"]).collect()
    big = sorted((r.level_index, r.level) for r in got if r.feature == "big")
    assert [i for i, _ in big] == list(range(5000))
    assert [lv for _, lv in big] == sorted(lv for _, lv in big)
    assert sorted((r.level, r.level_index) for r in got if r.feature == "small") == [("a", 0), ("b", 1)]


def test_levels_with_quotes_and_backslashes_score_exactly(spark):
    from emberline.operators.model import LinearModel, Preprocess
    odd = ["it's", "back\\slash", "new\nline", "plain"]
    pre = Preprocess(["x"], [0.0], [1.0], ["c"], {"c": sorted(odd)})
    names = pre.feature_names()
    # class "a" gets weight 1 on each odd level, 0 elsewhere; class "b" is flat
    w_a = [0.0] + [1.0 if n != "c=plain" else 0.0 for n in names[1:]]
    model = LinearModel(["a", "b"], pre, [w_a, [0.0] * len(names)], [0.0, 0.0], label="y")
    df = spark.createDataFrame([(0.0, v) for v in odd] + [(0.0, "unseen")], "x double, c string")
    got = {r.c: r.predicted_y for r in predict(model, df).collect()}
    assert got == {"it's": "a", "back\\slash": "a", "new\nline": "a", "plain": "a", "unseen": "a"}
    probs = {r.c: r.predicted_y_probs[0]["prob"] for r in predict(model, df).collect()}
    assert probs["plain"] == 0.5 and probs["unseen"] == 0.5 and probs["it's"] > 0.7


def test_parameters_are_values_and_never_text(spark):
    """A region name with quotes or SQL in it is compared as it is."""
    from emberline.operators.enrich import engineer
    from emberline.plans import serve as SV
    from emberline.sources.observations import inline_observations
    odd = ["O'Brien's; DROP TABLE x --", 'a"b', "%", "' OR '1'='1"]
    rows = engineer(inline_observations(spark)).limit(len(odd))
    named = rows.withColumn("state_province", F.element_at(F.array(*[F.lit(x) for x in odd]), (F.monotonically_increasing_id() % len(odd) + 1).cast("int")))
    preds = predict(fixed_model(), named).persist()
    held = {r.state_province for r in preds.collect()}
    for x in odd:
        assert {r.state_province for r in SV.prediction_for_state(preds, x.upper()).collect()} == ({x} & held)
    assert SV.prediction_for_state(preds, "' OR 1=1 --").count() == 0
    preds.unpersist()
