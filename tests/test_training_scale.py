"""Training and serving without size bounds: many regions and levels, NaN cells, duplicate lookup keys."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators.enrich import centroid_table, enrich_coordinates
from emberline.operators.model import Preprocess, first_of, fixed_model, predict
from emberline.operators.train import TrainConfig, optimality, prepare, gradient_sums, gradient_sums_arrow, train_gd, train_lr
from emberline.plans import oracle as O
from emberline.plans import serve as SV
from emberline.sources.generator import generate_training


def test_150_000_regions(spark):
    many = spark.range(300_000).select(F.concat(F.lit("r"), F.col("id") % 150_000).alias("state_province"))
    out = SV.available_states(many)
    assert out.agg(F.count("*"), F.min("state_index"), F.max("state_index"), F.min("n_states")).first()[:] == \
        (150_000, 0, 149_999, 150_000)
    order = out.where("state_index in (0, 1, 149999)").orderBy("state_index").collect()
    assert [r.state_province for r in order] == ["r0", "r1", "r99999"]


def test_blocks_and_dense_columns_give_the_same_gradient(spark):
    df = generate_training(spark, 3000, 5).withColumn(
        "weather_condition", F.when(F.col("row_id") % 50 == 0, None).otherwise(F.col("weather_condition")))
    cfg = TrainConfig()
    pre, _, classes, dense, _ = prepare(df, cfg)
    _, _, _, blocks, _ = prepare(df, cfg, packed=True)
    rng = np.random.default_rng(0)
    W, b = rng.normal(size=(len(classes), len(pre.feature_names()))), rng.normal(size=len(classes))
    one = gradient_sums(dense, classes, W, b, W.shape[1])
    two = gradient_sums_arrow(blocks, classes, W, b, pre)
    for key in ("G", "gb", "loss"):
        assert np.allclose(one[key], two[key], rtol=1e-9, atol=1e-9)
    dense.unpersist(), blocks.unpersist()


def test_1_500_levels(spark):
    df = generate_training(spark, 6000, 6).withColumn("weather_condition", F.concat(F.lit("w"), F.col("row_id") % 1500))
    model = train_gd(df, TrainConfig(iterations=2))
    assert len(model.pre.vocab["weather_condition"]) == 1500
    assert model.history[1] < model.history[0]


def test_a_nan_cell_counts_as_missing(spark):
    df = generate_training(spark, 1500, 7)
    one = F.col("row_id") == 10
    cfg = TrainConfig(iterations=3)
    models = [train_gd(df.withColumn("temperature_celsius", F.when(one, F.lit(x).cast("double")).otherwise(
        F.col("temperature_celsius"))), cfg) for x in (None, float("nan"))]
    assert np.allclose(models[0].weights, models[1].weights, atol=1e-12) and np.isfinite(models[0].weights).all()
    row = df.where(one)
    scored = [predict(models[0], row.withColumn("temperature_celsius", F.lit(x).cast("double"))).first()[-1]
              for x in (None, float("nan"))]
    assert scored[0] == scored[1]


def test_the_converged_model_is_optimal_and_an_early_one_is_not(spark):
    df = generate_training(spark, 2000, 8)
    assert optimality(df, train_lr(df)).where("not optimal").count() == 0
    assert optimality(df, train_gd(df, TrainConfig(iterations=1))).where("not optimal").count() > 0


def test_duplicate_centroids_do_not_multiply_rows(spark):
    twice = centroid_table(spark).unionByName(centroid_table(spark).withColumn("lon", F.col("lon") + 1))
    df = spark.createDataFrame([("1", "Bayern"), ("2", "nowhere"), ("3", None)], "row_id string, state_province string")
    got = enrich_coordinates(df, centroids=twice).collect()
    want = enrich_coordinates(df).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_first_element_of_an_empty_array(spark):
    df = spark.createDataFrame([([],)], "p array<struct<label:string,prob:double>>")
    assert df.select(first_of("p", "label")).first()[0] is None
    with pytest.raises(Exception, match="empty"):
        df.select(first_of("p", "label", strict=True)).collect()


def test_rank_position_follows_the_order(spark):
    rows = SV.current_predictions(predict(fixed_model(), generate_training(spark, 500, 9).withColumn(
        "timestamp", F.lit("2024-01-01").cast("timestamp_ntz")))).orderBy("rank_position").collect()
    assert [r.rank_position for r in rows] == list(range(1, 501))
    assert [r.risk_probability for r in rows] == sorted((r.risk_probability for r in rows), reverse=True)


def test_generated_rows_match_duckdb(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE lineitem AS SELECT * FROM range(300)")
    want = con.execute(O.GEN + " ORDER BY row_id").df()
    got = generate_training(spark, 300).orderBy("row_id").toPandas()[list(want.columns)]
    for c in want.columns:
        assert np.allclose(got[c], want[c]) if want[c].dtype.kind == "f" else got[c].tolist() == want[c].tolist()


def test_no_levels_at_all():
    assert Preprocess([], [], [], ["c"], {"c": []}).feature_names() == []
