"""DataFrame -> DataFrame operators."""

from .enrich import (centroid_table, coordinates_sql, derived_sql, engineer, enrich_coordinates,
                     label_rows)
from .evaluation import (auc_by_class, confusion, confusion_with_loss, evaluate, log_loss,
                       macro_metrics, per_class, roc_auc)
from .model import LinearModel, Preprocess, first_of, fixed_model, predict, prob_of
from .pipeline import fit_pipeline, load_pipeline, predict_pipeline, save_pipeline
from .ranking import read_ranked, store_ranked
from .row_id import with_row_id
from .stats import statistics
from .table_model import TableModel, as_table_model, predict_table, train_gd_table
from .train import (TrainConfig, class_weights, first_step, moments, optimality, split,
                    train_gd, train_lr, vocabulary)

__all__ = [
    "centroid_table", "coordinates_sql", "derived_sql", "engineer", "enrich_coordinates",
    "label_rows",
    "auc_by_class", "confusion", "confusion_with_loss", "evaluate", "log_loss",
    "macro_metrics", "per_class", "roc_auc",
    "LinearModel", "Preprocess", "first_of", "fixed_model", "predict", "prob_of",
    "fit_pipeline", "load_pipeline", "predict_pipeline", "save_pipeline",
    "read_ranked", "store_ranked", "with_row_id", "statistics",
    "TableModel", "as_table_model", "predict_table", "train_gd_table",
    "TrainConfig", "class_weights", "first_step", "moments", "optimality", "split",
    "train_gd", "train_lr", "vocabulary",
]
