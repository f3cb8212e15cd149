"""Namespaces, tables, model round trip, registry, sinks, streaming, batch run."""

import os

import pytest

from pyspark.sql import functions as F

from emberline import catalog as C
from emberline import reference_values as RV
from emberline.operators.enrich import engineer
from emberline.operators.model import fixed_model, predict
from emberline.plans import serve as SV
from emberline.plans.batch_job import BatchConfig, run_batch
from emberline.operators.train import TrainConfig
from emberline.sources.observations import inline_observations
from emberline.streaming import start_scoring


def test_namespace_table_model_registry(spark, tmpdir_path):
    ns = "emb_test_ns"
    C.ensure_namespace(spark, ns, "test namespace", {"purpose": "tests"})
    C.ensure_namespace(spark, ns)                    # idempotent
    df = spark.range(5)
    C.save_table(df, "t", ns)
    C.save_table(df.limit(3), "t", ns)               # create-or-replace twice
    assert C.count_rows(C.read_saved(spark, "t", ns)).first()["row_count"] == 3
    m = fixed_model()
    C.save_model(spark, m, ns)
    C.save_model(spark, m, ns)                       # replace keeps one registry row
    reg = C.registry(spark, ns)
    assert reg.where(F.col("model_name") == m.name).count() == 1
    back = C.load_model(spark, m.name, ns)
    obs = engineer(inline_observations(spark))
    cols = ["station_id", "predicted_" + RV.LABEL_COLUMN, "predicted_" + RV.LABEL_COLUMN + "_probs"]
    a = sorted(tuple(r) for r in predict(m, obs).select(*cols).collect())
    b = sorted(tuple(r) for r in predict(back, obs).select(*cols).collect())
    assert a == b                                   # labels and probabilities, bit for bit
    info = SV.model_info(reg, m.name).first()
    assert info["model_name"] == m.name and info["model_schema"] == ns
    missing = SV.model_info_or_error(reg, "nope").first()
    assert missing["error"] == "Model not found" and missing["model_name"] == "nope"
    asked = spark.createDataFrame([(m.name,), ("nope",)], "model_name string")
    both = {r.model_name: r for r in SV.model_info_batch(reg, asked).collect()}
    assert both[m.name]["error"] is None and both[m.name]["model_schema"] == ns
    assert both["nope"]["error"] == "Model not found" and both["nope"]["model_schema"] is None
    saves = C.read_saved(spark, C.REGISTRY, ns)
    assert saves.count() == 2 and saves.select("creation_time").distinct().count() == 1
    C.write_json(SV.available_states(predict(m, obs)), os.path.join(tmpdir_path, "j"), as_strings=True)
    C.write_csv(C.count_rows(obs), os.path.join(tmpdir_path, "c"))
    assert spark.read.json(os.path.join(tmpdir_path, "j")).count() == 16
    C.drop_namespace(spark, ns)
    assert not spark.catalog.databaseExists(ns)


def test_streaming_scoring_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    sink = os.path.join(tmpdir_path, "out")
    obs = inline_observations(spark)
    obs.limit(8).write.parquet(os.path.join(src, "part1"))
    m = fixed_model()
    q = start_scoring(spark, os.path.join(src, "*"), sink, m,
                      checkpoint=os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.count() == 8
    label = "predicted_" + RV.LABEL_COLUMN
    batch = predict(m, engineer(obs.limit(8)))
    assert sorted(r[label] for r in out.collect()) == sorted(r[label] for r in batch.collect())
    assert "state_key" in out.columns
    assert SV.prediction_for_state(out, "bayern").count() == 1


def test_a_second_streaming_run_adds_only_the_new_rows(spark, tmpdir_path):
    src, sink = os.path.join(tmpdir_path, "in2"), os.path.join(tmpdir_path, "out2")
    obs = inline_observations(spark)
    for part, rows, total in (("part1", obs.limit(8), 8), ("part2", obs.orderBy("station_id").limit(1), 9)):
        rows.write.parquet(os.path.join(src, part))
        start_scoring(spark, os.path.join(src, "*"), sink, fixed_model()).awaitTermination(120)
        assert spark.read.parquet(sink).count() == total


def test_batch_run_on_a_given_table_survives_a_failing_evaluation(spark, monkeypatch):
    from emberline.plans import batch_job
    from emberline.sources.generator import generate_training

    def broken(*a, **k):
        raise RuntimeError("no metrics today")
    monkeypatch.setattr(batch_job, "evaluate", broken)
    cfg = BatchConfig(namespace="emb_batch2", train=TrainConfig(iterations=2))
    with pytest.warns(UserWarning, match="no metrics today"):
        res = run_batch(spark, cfg, training=generate_training(spark, 700, 3))
    summary = {r.metric: r.value for r in res["summary"].collect()}
    assert summary == {"training_rows": "700", "prediction_rows": "16", "accuracy": "N/A", "roc_auc": "N/A"}
    assert res["sample"].count() == 5
    C.drop_namespace(spark, "emb_batch2")


def test_batch_run_end_to_end(spark, tmpdir_path):
    cfg = BatchConfig(namespace="emb_batch", training_rows=1000,
                      train=TrainConfig(iterations=5),
                      evaluation_path=os.path.join(tmpdir_path, "eval"))
    res = run_batch(spark, cfg)
    assert res["training_rows"] == 1000 and res["prediction_rows"] == 16
    assert 0.0 <= res["metrics"]["accuracy"] <= 1.0
    assert res["sample"].count() == 5
    ev = spark.read.json(os.path.join(tmpdir_path, "eval")).first().asDict()
    assert set(ev) == {"accuracy", "f1_score", "log_loss", "precision", "recall", "roc_auc"}
    assert all(isinstance(v, str) for v in ev.values())
    summary = {r.metric: r.value for r in res["summary"].collect()}
    assert summary["training_rows"] == "1000" and summary["prediction_rows"] == "16"
    C.drop_namespace(spark, "emb_batch")


def test_partitioned_predictions_prune_region_lookup(spark):
    ns = "emb_part_ns"
    C.ensure_namespace(spark, ns)
    preds = predict(fixed_model(), engineer(inline_observations(spark)))
    C.save_predictions(preds, "preds", ns)
    stored = C.read_saved(spark, "preds", ns)
    q = SV.prediction_for_state(stored, "SACHSEN")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state_key" in plan and "= sachsen)" in plan
    rows = q.collect()
    assert len(rows) == 1 and rows[0]["station_id"] == "station_SN"
    assert SV.available_states(stored).first()["n_states"] == 16
    C.drop_namespace(spark, ns)


def test_batch_command_line(spark, tmpdir_path, capsys):
    from emberline.plans.batch_job import main
    out = os.path.join(tmpdir_path, "eval_cli")
    main(["--rows", "600", "--namespace", "emb_cli_test", "--evaluation-path", out])
    printed = capsys.readouterr().out
    assert "training rows: 600" in printed and "predictions: 16" in printed
    assert spark.read.json(out).count() == 1
    C.drop_namespace(spark, "emb_cli_test")
