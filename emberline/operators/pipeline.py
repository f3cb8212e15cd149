"""The converged model as a Spark ML Pipeline that is saved and loaded whole.

Stages: numeric inputs standardised by SQL over the moments (missing: the mean),
levels indexed with one more place for what was not seen, sparse one-hot vectors
in which that place is all zeros, one assembled vector, and a multinomial
logistic regression with elastic net.  A loaded PipelineModel scores rows
without the class that trained it.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import ident, num
from .model import LinearModel, Preprocess, probability_columns
from .stats import TableStats, statistics
from .table_model import balanced_weights

MAX_ITERATIONS = 500      # of the solver; it stops earlier when the objective settles
TOLERANCE = 1e-9
FEATURES, LABEL_INDEX, WEIGHT = "_features", "_label_index", "_weight"


def _standardised(c: str, mean: float, std: float) -> str:
    return f"coalesce((nullif(CAST({ident(c)} AS DOUBLE), double('NaN')) - {num(mean)}) / {num(std)}, {num(0.0)})"


def stages(cfg, means: list[float], stds: list[float], classes: list[str]) -> list:
    """The stages for a training configuration; features come in the order of
    ``Preprocess.feature_names``."""
    numeric = [f"_z{i}" for i in range(len(cfg.numeric))]
    index = [f"_i{i}" for i in range(len(cfg.categorical))]
    hot = [f"_h{i}" for i in range(len(cfg.categorical))]
    exprs = [f"{_standardised(c, m, s)} AS {z}" for c, m, s, z in zip(cfg.numeric, means, stds, numeric)]
    texts = [f"CAST({ident(c)} AS STRING) AS _t{i}" for i, c in enumerate(cfg.categorical)]
    out = [SQLTransformer(statement=f"SELECT *, {', '.join(exprs + texts)} FROM __THIS__")] if exprs + texts else []
    if index:
        out += [StringIndexer(inputCols=[f"_t{i}" for i in range(len(index))], outputCols=index, handleInvalid="keep",
                              stringOrderType="alphabetAsc"),
                # the last place, of unseen levels and NULL, is dropped: all zeros
                OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True)]
    reg = cfg.l1 + cfg.l2
    out += [VectorAssembler(inputCols=[*numeric, *hot], outputCol=FEATURES),
            LogisticRegression(featuresCol=FEATURES, labelCol=LABEL_INDEX, weightCol=WEIGHT, family="multinomial",
                               maxIter=MAX_ITERATIONS, tol=TOLERANCE, regParam=reg,
                               elasticNetParam=(cfg.l1 / reg) if reg > 0 else 0.0, standardization=False, fitIntercept=True,
                               probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction")]
    return out


def fit_pipeline(df: DataFrame, cfg, stats: TableStats | None = None) -> tuple[PipelineModel, list[str]]:
    """The fitted pipeline and its classes in order.  Rows without a label are left out."""
    needed = list(dict.fromkeys(cfg.numeric + cfg.categorical + [cfg.label]))
    stats = stats or statistics(df.select(*needed), cfg.numeric, [*cfg.categorical, cfg.label])
    means, stds = stats.means_and_stds()
    weights = balanced_weights(stats, cfg)
    classes = sorted(weights)
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(cfg.label).cast("string")) - 1
    weight = F.get(F.array(*[F.lit(float(weights[c])) for c in classes]), F.col(LABEL_INDEX).cast("int"))
    rows = df.select(*needed).where(F.col(cfg.label).isNotNull()).withColumn(
        LABEL_INDEX, place.cast("double")).withColumn(WEIGHT, weight)
    return Pipeline(stages=stages(cfg, means, stds, classes)).fit(rows), classes


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Write the pipeline under a new path; readers find it once its last file is there."""
    model.write().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict_pipeline(model: PipelineModel, df: DataFrame, classes: list[str], label: str,
                     prob_columns: bool = False) -> DataFrame:
    """Input columns, predicted label and (label, prob) array, as ``model.predict`` gives them."""
    scored = model.transform(df).withColumn("_logits", vector_to_array("_raw"))
    return probability_columns(scored, df.columns, classes, [], [f"get(_logits, {k})" for k in range(len(classes))],
                               f"predicted_{label}", f"predicted_{label}_probs", prob_columns)


def linear_model(model: PipelineModel, cfg, classes: list[str], means: list[float], stds: list[float]) -> LinearModel:
    """The pipeline's coefficients as a ``LinearModel``."""
    lr = model.stages[-1]
    levels = next((s.labelsArray for s in model.stages if hasattr(s, "labelsArray")), [])
    pre = Preprocess(list(cfg.numeric), means, stds, list(cfg.categorical),
                     {c: list(v) for c, v in zip(cfg.categorical, levels)})
    coef, icpt = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    d = len(pre.feature_names())
    seen = range(min(len(classes), coef.shape[0]))
    W = [[float(x) for x in coef[i]] if i in seen else [0.0] * d for i in range(len(classes))]
    b = [float(icpt[i]) if i in seen else 0.0 for i in range(len(classes))]
    history = list(lr.summary.objectiveHistory) if lr.hasSummary else []
    return LinearModel(classes, pre, W, b, name=cfg.name, label=cfg.label, history=history)
