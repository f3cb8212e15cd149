"""Hot keys, partition invariance and generator statistics."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from emberline import reference_values as RV
from emberline.operators.enrich import engineer
from emberline.operators.model import fixed_model, predict
from emberline.operators.train import split
from emberline.plans import serve as SV
from emberline.sources.generator import generate_training
from emberline.sources.observations import inline_observations


def _hot_predictions(spark, copies=3000):
    """The 16 observations plus thousands of Bayern rows (one region holds most rows)."""
    obs = inline_observations(spark)
    hot = obs.where(F.col("state_province") == "Bayern")
    many = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_c"))
    many = many.withColumn("temperature_celsius", F.col("temperature_celsius") + F.col("_c") / 1000.0).drop("_c")
    return predict(fixed_model(), engineer(obs.unionByName(many).repartition(7)))


def test_lookup_with_a_hot_region(spark):
    preds = _hot_predictions(spark)
    firsts = {r.state_key: r.rec for r in SV.first_per_state(preds).collect()}
    assert len(firsts) == 16
    # the smallest record of the hot region: station order ties, then the lowest temperature
    assert firsts["bayern"]["temperature_celsius"] == 31.0
    req = spark.createDataFrame([("BAYERN",), ("berlin",)], "requested_state string")
    out = {r.requested_state: r for r in SV.lookup(req, preds).collect()}
    assert out["BAYERN"]["found"] and out["BAYERN"]["temperature_celsius"] == 31.0
    single = SV.prediction_for_state(preds, "bayern").collect()
    assert single[0]["temperature_celsius"] == 31.0
    assert SV.available_states(preds).first()["n_states"] == 16


def test_split_and_scores_partition_invariant(spark):
    a = generate_training(spark, 5000, seed=11, num_partitions=1)
    b = generate_training(spark, 5000, seed=11, num_partitions=9).repartition(4)
    ta, ea = split(a)
    tb, eb = split(b)
    assert sorted(r.row_id for r in ea.select("row_id").collect()) == \
        sorted(r.row_id for r in eb.select("row_id").collect())
    label = "predicted_" + RV.LABEL_COLUMN
    pa = {r.row_id: r[label] for r in predict(fixed_model(), ta).select("row_id", label).collect()}
    pb = {r.row_id: r[label] for r in predict(fixed_model(), tb).select("row_id", label).collect()}
    assert pa == pb


def test_label_shares_follow_the_uniform_ranges(spark):
    g = generate_training(spark, 40000, seed=9)
    n = 40000
    shares = {r[0]: r[1] / n for r in g.groupBy(RV.LABEL_COLUMN).count().collect()}
    # high: P(t>30)P(h<30)P(w>10) = .2*(10/70)*(1/3); moderate: P(t>25)P(h<50) - high
    p_high = 0.2 * (10 / 70) * (1 / 3)
    p_mod = 0.4 * (30 / 70) - p_high
    assert abs(shares["high"] - p_high) < 0.004
    assert abs(shares["moderate"] - p_mod) < 0.01
    assert abs(shares["low"] - (1 - p_high - p_mod)) < 0.01
    eval_share = split(g)[1].count() / n
    assert abs(eval_share - RV.EVAL_FRACTION) < 0.01
    assert np.isclose(sum(shares.values()), 1.0)


def test_generator_rows_per_partition_changes_layout_not_rows(spark):
    a = generate_training(spark, 4000, seed=2, rows_per_partition=300)
    b = generate_training(spark, 4000, seed=2)
    assert a.rdd.getNumPartitions() > b.rdd.getNumPartitions()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_first_record_per_region_with_null_nan_and_ties(spark):
    """The minimum of the record is the first row of a sorted window, and is taken before the shuffle."""
    i = F.col("id")
    rows = spark.range(0, 20_000, 1, 4).select(
        F.when(i % 11 != 0, F.concat(F.lit("r"), (F.hash("id") % 5_000).cast("string"))).alias("state_key"),
        F.when(i % 7 != 0, (i % 3).cast("string")).alias("name"),
        F.when(i % 5 == 0, F.lit(float("nan"))).when(i % 5 != 1, F.rand(1)).alias("x"),
        F.when(i % 2 == 0, -0.0).otherwise(0.0).alias("y"), F.timestamp_seconds(i % 4).alias("t"))
    order = ["name", "x", "y", "t"]
    place = F.row_number().over(Window.partitionBy("state_key").orderBy(*order))
    want = rows.withColumn("place", place).where("place = 1").select("state_key", *order)
    got = SV.first_rows(rows, "state_key", order)
    assert "partial_min" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == want.count()
    assert want.exceptAll(got).isEmpty()
