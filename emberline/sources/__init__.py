"""Table sources: parquet readers, the synthetic generator, observation tables."""

from .generator import generate_training, id_range, synthetic_rows, training_from_ids
from .observations import from_lineitem, inline_observations
from .tables import TABLES, read_table, register_views

__all__ = ["generate_training", "id_range", "synthetic_rows", "training_from_ids",
           "from_lineitem", "inline_observations", "TABLES", "read_table",
           "register_views"]
