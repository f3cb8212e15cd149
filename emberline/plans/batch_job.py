"""The end-to-end batch run: generate, train, score, evaluate, sample.

Each stage starts after the previous one has been written: the hand-offs are
stored tables in a namespace.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog as C
from .. import reference_values as RV
from ..operators.enrich import engineer
from ..operators.evaluation import evaluate
from ..operators.model import predict
from ..operators.train import TrainConfig, split, train_gd, train_lr
from ..sources.generator import generate_training
from ..sources.observations import inline_observations
from . import serve as SV


@dataclass
class BatchConfig:
    namespace: str = C.DEFAULT_NAMESPACE
    training_rows: int = RV.DEFAULT_TRAINING_ROWS
    seed: int = 42
    converged: bool = False              # Spark ML L-BFGS instead of constant-rate steps
    train: TrainConfig = field(default_factory=TrainConfig)
    evaluation_path: str | None = None   # JSON of the evaluation: one file if it ends in .json, else a folder
    comment: str = "Wildfire risk prediction data and models"
    labels: dict = field(default_factory=lambda: {"purpose": "wildfire-prediction"})


def run_batch(spark: SparkSession, cfg: BatchConfig | None = None,
              observations: DataFrame | None = None, training: DataFrame | None = None) -> dict:
    """Run every stage; returns counts, metrics and the sample as DataFrames/values.

    ``training`` is the table to train on (its ``row_id`` decides the split);
    without one a table is generated.  A failing evaluation is a warning: the
    model, the predictions, the sample and the summary are there all the same.
    """
    cfg = cfg or BatchConfig()
    C.ensure_namespace(spark, cfg.namespace, cfg.comment, cfg.labels)

    if training is None:
        training = generate_training(spark, cfg.training_rows, cfg.seed)
    C.save_table(training, RV.TRAINING_TABLE, cfg.namespace)
    training = C.read_saved(spark, RV.TRAINING_TABLE, cfg.namespace)
    training_count = C.count_rows(training).first()["row_count"]

    train_part, eval_part = split(training, "row_id", cfg.seed, RV.EVAL_FRACTION)
    trainer = train_lr if cfg.converged else train_gd
    model = trainer(train_part, cfg.train)
    C.save_model(spark, model, cfg.namespace)

    obs = observations if observations is not None else inline_observations(spark)
    preds = predict(model, engineer(obs))
    C.save_predictions(preds, RV.PREDICTIONS_TABLE, cfg.namespace)
    preds = C.read_saved(spark, RV.PREDICTIONS_TABLE, cfg.namespace)
    prediction_count = C.count_rows(preds).first()["row_count"]

    scored_eval = predict(model, eval_part)
    label = model.label
    names = ("accuracy", "f1_score", "log_loss", "precision", "recall", "roc_auc")
    try:
        metrics = evaluate(scored_eval, label, f"predicted_{label}", f"predicted_{label}_probs",
                           model.classes, labels=model.classes)
    except Exception as e:  # noqa: BLE001 - reported, as the run's results do not depend on it
        warnings.warn(f"evaluation failed: {e}", stacklevel=2)
        metrics = dict.fromkeys(names)
    metrics_df = spark.createDataFrame(
        [tuple(None if metrics[k] is None else float(metrics[k]) for k in names)],
        "accuracy double, f1_score double, log_loss double, precision double, "
        "recall double, roc_auc double")
    if cfg.evaluation_path:
        write = C.write_record if cfg.evaluation_path.endswith(".json") else C.write_json
        write(metrics_df, cfg.evaluation_path, as_strings=True)

    return {
        "model": model,
        "training_rows": training_count,
        "prediction_rows": prediction_count,
        "metrics": metrics,
        "sample": SV.sample_predictions(preds, 5),
        "summary": SV.summary_rows(training, preds, {
            "accuracy": metrics_df.select(F.col("accuracy")),
            "roc_auc": metrics_df.select(F.col("roc_auc"))}),
    }


def main(argv=None) -> None:
    """``python -m emberline.plans.batch_job --rows 1000 --namespace wildfire``."""
    import argparse
    import json

    from ..session import build_session

    ap = argparse.ArgumentParser(description="generate, train, score, evaluate, sample")
    ap.add_argument("--namespace", default=C.DEFAULT_NAMESPACE)
    ap.add_argument("--rows", type=int, default=RV.DEFAULT_TRAINING_ROWS)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--converged", action="store_true", help="Spark ML L-BFGS instead of GD")
    ap.add_argument("--evaluation-path", default=None, help="write the metrics as JSON here")
    ap.add_argument("--observations-dir", default=None,
                    help="score the observation view of lineitem.parquet in this folder "
                         "instead of the sixteen next-day rows")
    ap.add_argument("--training-table", default=None, help="train on this table instead of a generated one")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(args.master, app="emberline-batch")
    observations = None
    if args.observations_dir:
        from ..sources.observations import from_lineitem
        from ..sources.tables import read_table
        observations = from_lineitem(read_table(spark, args.observations_dir, "lineitem"))
    training = spark.table(args.training_table) if args.training_table else None
    res = run_batch(spark, BatchConfig(namespace=args.namespace, training_rows=args.rows,
                                       seed=args.seed, converged=args.converged,
                                       evaluation_path=args.evaluation_path),
                    observations=observations, training=training)
    print(f"training rows: {res['training_rows']}")
    print(f"predictions: {res['prediction_rows']}")
    print(json.dumps({k: (None if v is None else str(v)) for k, v in res["metrics"].items()}))
    res["sample"].show(truncate=False)


if __name__ == "__main__":
    main()
