"""One-scan statistics, the model with its levels in a table, and the saved pipeline."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline import catalog as C
from emberline.operators import stats as ST
from emberline.operators import train as T
from emberline.operators.model import predict
from emberline.operators.pipeline import fit_pipeline, load_pipeline, predict_pipeline, save_pipeline
from emberline.operators.table_model import as_table_model, predict_table, train_gd_table
from emberline.operators.train import TrainConfig, optimality, train_gd, train_lr
from emberline.sources.generator import generate_training


@pytest.fixture(scope="module")
def rows(spark):
    df = generate_training(spark, 3000, 5)
    return df.withColumn("weather_condition", F.when(F.col("row_id") % 50 == 0, None).otherwise(F.col("weather_condition"))).withColumn(
        "temperature_celsius", F.when(F.col("row_id") % 40 == 0, float("nan")).otherwise(F.col("temperature_celsius")))


def coefficients(frame):
    return {(r["class"], r["feature"]): r["weight"] for r in frame.collect()}


def test_statistics_match_spark_and_read_once(spark, rows):
    cols = ["temperature_celsius", "pressure_hpa", "month"]
    got = ST.statistics(rows, cols, ["weather_condition", "state_province"])
    m = {r.feature: r for r in got.moments().collect()}
    for c in cols:
        x = F.nullif(F.col(c).cast("double"), F.lit(float("nan")))
        want = rows.agg(F.avg(x), F.stddev_samp(x)).first()
        assert math.isclose(m[c].mean, want[0], rel_tol=1e-12) and math.isclose(m[c].std, want[1], rel_tol=1e-9)
    levels = {(r.feature, r.level): r.n for r in got.levels().collect()}
    want = {("weather_condition", r[0]): r[1] for r in rows.where("weather_condition IS NOT NULL").groupBy("weather_condition").count().collect()}
    want |= {("state_province", r[0]): r[1] for r in rows.groupBy("state_province").count().collect()}
    assert levels == want


def test_statistics_of_odd_columns(spark, monkeypatch):
    monkeypatch.setattr(ST, "HELD_LEVELS", 3)
    big = [(1e9 + i % 2, None, f"l{i % 7}") for i in range(40)] + [(None, float("nan"), None)]
    df = spark.createDataFrame(big, "a double, b double, c string").repartition(5)
    got = ST.statistics(df, ["a", "b"], ["c"])
    m = {r.feature: r for r in got.moments().collect()}
    assert m["a"].mean == 1e9 + 0.5 and math.isclose(m["a"].std, math.sqrt(0.25 * 40 / 39), rel_tol=1e-9)
    assert m["b"].mean is None and m["b"].std is None
    assert got.means_and_stds() == ([1e9 + 0.5, 0.0], [m["a"].std, 1.0])
    assert {r.level: r.n for r in got.levels().collect()} == {f"l{k}": sum(i % 7 == k for i in range(40)) for k in range(7)}
    none = ST.statistics(df.where("a < 0"), ["a"], ["c"])
    assert none.levels().count() == 0 and none.means_and_stds() == ([0.0], [1.0])


def test_the_table_trainer_makes_the_same_steps(spark, rows):
    cfg = TrainConfig(iterations=6)
    one, two = train_gd(rows, cfg), train_gd_table(rows, cfg)
    a = {(c, f): w for c, f, w in one.coefficient_rows()}
    b = coefficients(two.coefficient_table())
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-10
    assert np.allclose(one.history, two.history, rtol=1e-10)
    for model in (two, as_table_model(spark, one)):
        p, q = (sorted(f.select("row_id", *[F.round(f"prob_{c}", 9) for c in one.classes], F.col(f"predicted_{one.label}")).collect())
                for f in (predict(one, rows, prob_columns=True), predict_table(model, rows, prob_columns=True)))
        assert p == q


def test_the_plan_does_not_grow_with_the_levels(spark, rows):
    sizes = []
    for k in (10, 2000):
        df = rows.withColumn("weather_condition", F.concat(F.lit("w"), F.col("row_id") % k))
        model = train_gd_table(df, TrainConfig(iterations=1))
        assert model.coefficients.where("feature = 'weather_condition'").count() == k
        sizes.append(len(predict_table(model, df)._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(sizes[1] - sizes[0]) < 500   # 2,000 levels would take tens of thousands of characters


def test_unseen_levels_and_clashing_columns(spark, rows):
    model = train_gd_table(rows, TrainConfig(iterations=1))
    odd = rows.limit(3).withColumns({"state_province": F.lit("nowhere"), "weather_condition": F.lit(None).cast("string"), "w": F.lit(1), "level": F.lit("x")})
    same = as_table_model(spark, train_gd(rows, TrainConfig(iterations=1)))
    a, b = (sorted(map(str, predict(m, odd).select("row_id", "w", "level", f"predicted_{m.label}").collect())) for m in (model, same))
    assert a == b and len(a) == 3


def test_a_table_model_is_saved_and_loaded(spark, rows):
    ns = "emb_table_model"
    C.drop_namespace(spark, ns)
    C.ensure_namespace(spark, ns)
    model = train_gd_table(rows, TrainConfig(iterations=1))
    C.save_model(spark, model, ns)
    back = C.load_model(spark, model.name, ns)
    assert coefficients(back.coefficient_table()) == coefficients(model.coefficient_table())
    C.drop_namespace(spark, ns)


def test_a_million_levels_train_without_a_vocabulary_on_the_driver(spark, monkeypatch):
    df = spark.range(1_000_000, numPartitions=8).select(
        F.concat(F.lit("w"), "id").alias("kind"), (F.col("id") % 7).cast("double").alias("x"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"))
    cfg = TrainConfig(label="y", numeric=["x"], categorical=["kind"], iterations=2, l1=0.0)
    monkeypatch.setattr(T, "design_blocks", None)   # the form with levels in the plan is not taken
    model = train_gd(df, cfg)
    assert model.coefficients.count() == 1_000_000
    assert model.history[1] < model.history[0]
    up = model.coefficients.where("level IN ('w3', 'w4')").collect()
    assert {r.level: r.w[0] > 0 for r in up} == {"w3": True, "w4": False}


def test_more_levels_than_a_plan_holds_need_the_table(spark, monkeypatch):
    df = generate_training(spark, 500, 3)
    monkeypatch.setattr(T, "LITERAL_LEVELS", 3)
    with pytest.raises(ValueError, match="train_gd"):
        T.prepare(df, TrainConfig())
    model = train_gd(df, TrainConfig(iterations=1))
    assert model.coefficients.count() == df.select("weather_condition").distinct().count() + df.select("state_province").distinct().count()


def test_the_pipeline_round_trip(spark, rows, tmpdir_path):
    cfg = TrainConfig()
    fitted, classes = fit_pipeline(rows, cfg)
    path = os.path.join(tmpdir_path, "model")
    save_pipeline(fitted, path)
    back = load_pipeline(path)
    odd = rows.limit(50).unionByName(rows.limit(5).withColumn("state_province", F.lit("nowhere"))).drop(cfg.label)
    cols = ["row_id", "state_province", f"predicted_{cfg.label}", f"predicted_{cfg.label}_probs"]
    a, b = (sorted(map(str, predict_pipeline(m, odd, classes, cfg.label).select(*cols).collect())) for m in (fitted, back))
    assert a == b and len(a) == 55
    # the same as the linear model that is taken from it
    linear = train_lr(rows, cfg)
    one = {r[0]: r[1] for r in predict(linear, odd, prob_columns=True).select(F.struct("row_id", "state_province"), "prob_high").collect()}
    two = {r[0]: r[1] for r in predict_pipeline(back, odd, classes, cfg.label, True).select(F.struct("row_id", "state_province"), "prob_high").collect()}
    assert one.keys() == two.keys() and max(abs(one[k] - two[k]) for k in one) < 1e-9
    assert optimality(rows, linear).where("not optimal").count() == 0
    with pytest.raises(Exception):
        save_pipeline(fitted, path)   # a path is never overwritten
