"""Linear multi-class model: preprocessing state, coefficients, scoring.

Scoring is a narrow projection: standardisation, one-hot lookups, dot
products, a max-shifted softmax and the sorted (label, prob) array are all
built-in column expressions over literal coefficients.  The coefficients are
``k x d`` numbers (classes x features), so the plan carries them inline and
every executor scores its own partitions with no join, shuffle or UDF.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference_values as RV
from ..functions.sqltext import ident, num, text

def number(c: str) -> Column:
    """A numeric input as double, NaN as NULL."""
    return F.nullif(F.col(c).cast("double"), F.lit(float("nan")))


@dataclass
class Preprocess:
    """Training statistics: means/stds of numeric inputs, levels of categoricals."""

    numeric: list[str]
    means: list[float]
    stds: list[float]
    categorical: list[str] = field(default_factory=list)
    vocab: dict[str, list[str]] = field(default_factory=dict)

    def feature_names(self) -> list[str]:
        names = list(self.numeric)
        for c in self.categorical:
            names += [f"{c}={v}" for v in self.vocab[c]]
        return names

    def numeric_column(self, i: int) -> Column:
        """Standardised numeric input; NULL and NaN become 0 (the training mean)."""
        mu, sd = self.means[i], self.stds[i]
        return F.coalesce((number(self.numeric[i]) - F.lit(mu)) / F.lit(sd), F.lit(0.0))

    def feature_columns(self) -> list[Column]:
        """Dense design columns in ``feature_names`` order."""
        cols = [self.numeric_column(i) for i in range(len(self.numeric))]
        for c in self.categorical:
            for v in self.vocab[c]:
                cols.append(F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)))
        return cols


@dataclass
class LinearModel:
    """``classes`` sorted ascending; ``weights[c][j]`` pairs with ``feature_names()[j]``."""

    classes: list[str]
    pre: Preprocess
    weights: list[list[float]]
    intercepts: list[float]
    name: str = RV.DEFAULT_MODEL_NAME
    model_type: str = RV.MODEL_TYPE
    label: str = RV.LABEL_COLUMN
    history: list[float] = field(default_factory=list)
    created: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def n_numeric(self) -> int:
        return len(self.pre.numeric)

    def inputs_sql(self) -> list[str]:
        """What the logits of all classes read, each computed once for a row: the standardised
        numeric inputs, and for each categorical the array of its level's weights by class."""
        pre = self.pre
        out, j = standardised_sql(pre.numeric, pre.means, pre.stds), len(pre.numeric)
        for i, c in enumerate(pre.categorical):
            levels = pre.vocab[c]
            if levels:
                entries = ", ".join(f"{text(v)}, array({', '.join(num(w[j + at]) for w in self.weights)})" for at, v in enumerate(levels))
                out.append(f"try_element_at(map({entries}), CAST({ident(c)} AS STRING)) AS __w{i}")
            j += len(levels)
        return out

    def logit_sql(self, k: int) -> str:
        """The logit over those inputs as Spark SQL text (one parse instead of many column calls)."""
        return logit_sql(k, self.intercepts[k], self.weights[k][:self.n_numeric],
                         [i for i, c in enumerate(self.pre.categorical) if self.pre.vocab[c]])

    def coefficient_rows(self) -> list[tuple]:
        names = ["(intercept)"] + self.pre.feature_names()
        out = []
        for k, c in enumerate(self.classes):
            vals = [self.intercepts[k]] + list(self.weights[k])
            out += [(c, n, float(v)) for n, v in zip(names, vals)]
        return out


def standardised_sql(numeric: list[str], means: list[float], stds: list[float]) -> list[str]:
    """Standardised inputs ``__x0``, ...; NULL and NaN become 0 (the training mean)."""
    return [f"coalesce((nullif(CAST({ident(c)} AS DOUBLE), double('NaN')) - {num(mu)}) / {num(sd)}, {num(0.0)}) AS __x{j}"
            for j, (c, mu, sd) in enumerate(zip(numeric, means, stds))]


def logit_sql(k: int, intercept: float, weights: list[float], categorical) -> str:
    """Class ``k``'s logit from ``__x<j>`` and the arrays ``__w<i>``."""
    expr = num(intercept)
    for j, w in enumerate(weights):
        expr = f"({expr} + {num(w)} * __x{j})"
    for i in categorical:
        expr = f"({expr} + coalesce(get(__w{i}, {k}), {num(0.0)}))"
    return expr


def predict(model: LinearModel, df: DataFrame, label_col: str | None = None,
            probs_col: str | None = None, prob_columns: bool = False) -> DataFrame:
    """Input columns + predicted label + array<struct<label, prob>>.

    The array is ordered by probability descending, label ascending, so its
    first element is the predicted class.  Argmax ties go to the smallest
    label.  With ``prob_columns`` one ``prob_<class>`` column per class is
    added as well.  A ``TableModel`` is scored by joins.
    """
    if not isinstance(model, LinearModel):
        from .table_model import predict_table
        return predict_table(model, df, label_col, probs_col, prob_columns)
    return probability_columns(df, df.columns, model.classes, model.inputs_sql(), [model.logit_sql(i) for i in range(len(model.classes))],
                               label_col or f"predicted_{model.label}", probs_col or f"predicted_{model.label}_probs", prob_columns)


def probability_columns(df: DataFrame, columns: list[str], classes: list[str], inputs: list[str], logits: list[str],
                        label_col: str, probs_col: str, prob_columns: bool) -> DataFrame:
    """``columns`` of ``df`` and the predicted label, array and plain probabilities of the logits' SQL,
    which reads ``inputs``.

    The inputs have a projection of their own, as every class reads them: written into each
    class's logit they make a method of more bytecode than a JVM compiles.
    """
    k = len(classes)
    out_cols = [ident(c) for c in columns]
    L = [f"__l{i}" for i in range(k)]
    E = [f"__e{i}" for i in range(k)]
    P = [f"__p{i}" for i in range(k)]
    top = f"greatest({', '.join(L)})" if k > 1 else L[0]
    # four projections: inputs, logits, shifted exponentials, probabilities; each is
    # referenced several times below, so Catalyst keeps them materialised
    scored = (df.selectExpr("*", *inputs)
              .selectExpr("*", *[f"{logits[i]} AS {L[i]}" for i in range(k)])
              .selectExpr("*", *[f"exp({L[i]} - {top}) AS {E[i]}" for i in range(k)])
              .selectExpr("*", *[f"{E[i]} / ({' + '.join(E)}) AS {P[i]}" for i in range(k)]))
    # argmax over logits (exact, no exp), first class in ascending order wins ties
    whens = []
    for i, c in enumerate(classes):
        conds = [f"{L[i]} > {L[j]}" if j < i else f"{L[i]} >= {L[j]}" for j in range(k) if j != i]
        whens.append(f"WHEN {' AND '.join(conds) or 'true'} THEN {text(c)}")
    pred = f"CASE {' '.join(whens)} ELSE {text(classes[0])} END"
    extra = [f"{pred} AS {ident(label_col)}",
             f"{sorted_probs_sql(classes, P)} AS {ident(probs_col)}"]
    if prob_columns:
        extra += [f"{P[i]} AS {ident('prob_' + c)}" for i, c in enumerate(classes)]
    return scored.selectExpr(*out_cols, *extra)


def sorted_probs_sql(classes: list[str], probs: list[str]) -> str:
    """SQL text of array<struct<label, prob>>, by prob descending, label ascending.

    Sorted by the natural order of (-prob, label), without a comparison function.
    """
    items = [f"named_struct('k', 0.0D - {p}, 'label', {text(c)}, 'prob', {p})" for c, p in zip(classes, probs)]
    by_key = f"sort_array(array({', '.join(items)}))"
    return f"CAST(arrays_zip({by_key}.label, {by_key}.prob) AS ARRAY<STRUCT<label: STRING, prob: DOUBLE>>)"


def top_of(classes: list[str], prefix: str = "prob_") -> tuple[Column, Column]:
    """Label and probability of the first element of that array, from plain columns."""
    probs = [F.col(prefix + c) for c in sorted(classes)]
    top = F.greatest(*probs) if len(probs) > 1 else probs[0]
    label = F.coalesce(*[F.when(p == top, F.lit(c)) for c, p in zip(sorted(classes), probs)])
    return label, top


def prob_of(probs_col: str, label) -> Column:
    """Probability of ``label`` (a name or a column) from a (label, prob) array; 0 if absent."""
    key = F.lit(label) if isinstance(label, str) else label
    at = F.array_position(F.col(probs_col)["label"], key)
    return F.coalesce(F.try_element_at(F.col(probs_col)["prob"], F.nullif(at, F.lit(0)).cast("int")), F.lit(0.0))


def first_of(probs_col: str, field_name: str, strict: bool = False) -> Column:
    """``probs[0].field`` -- the first element; of an empty array NULL, or an error if ``strict``."""
    first = F.try_element_at(F.col(probs_col), F.lit(1))[field_name]
    if strict:
        first = F.when(F.size(probs_col) == 0, F.raise_error(F.lit(f"{probs_col} is empty"))).otherwise(first)
    return first


def fixed_preprocess() -> Preprocess:
    """Standardisation with the generator's own population moments.

    Uniform draws ``u*s+o`` have mean ``o+s/2`` and std ``s/sqrt(12)``; scores,
    elevation and month use the same rule on their ranges.  Lets a model be
    specified without a training pass (tests, oracle checks).
    """
    numeric = RV.NUMERIC_FEATURES + RV.ORDINAL_FEATURES
    ranges = dict(RV.NUMERIC_DRAWS)
    ranges["elevation_meters"] = RV.ELEVATION_DRAW
    ranges["temp_risk_score"] = (2.0, 2.0)
    ranges["humidity_risk_score"] = (2.0, 2.0)
    ranges["month"] = (11.0, 1.0)
    means = [ranges[c][1] + ranges[c][0] / 2.0 for c in numeric]
    stds = [ranges[c][0] / math.sqrt(12.0) for c in numeric]
    vocab = {"weather_condition": sorted(RV.WEATHER_LABELS),
             "state_province": sorted(RV.STATES)}
    return Preprocess(numeric, means, stds, list(RV.CATEGORICAL_FEATURES), vocab)


def fixed_model() -> LinearModel:
    """A hand-set three-class model (no training pass) used to check scoring.

    Heat, dryness and wind raise the two risk classes; rain, stormy and
    rainy weather lower them; state offsets are small and vary by position.
    """
    pre = fixed_preprocess()
    classes = ["high", "low", "moderate"]
    by_name = {
        "high": {"temperature_celsius": 2.1, "humidity_percent": -2.4, "wind_speed_ms": 1.3,
                 "precipitation_mm": -0.4, "temp_risk_score": 0.6, "humidity_risk_score": 0.5,
                 "pressure_hpa": 0.05, "visibility_km": 0.1, "month": 0.02},
        "low": {"temperature_celsius": -1.7, "humidity_percent": 1.9, "wind_speed_ms": -0.2,
                "precipitation_mm": 0.3, "temp_risk_score": -0.5, "humidity_risk_score": -0.6,
                "elevation_meters": 0.05, "wind_direction_degrees": -0.03},
        "moderate": {"temperature_celsius": 1.2, "humidity_percent": -1.1, "wind_speed_ms": 0.1,
                     "precipitation_mm": -0.1, "temp_risk_score": 0.4, "humidity_risk_score": 0.3,
                     "elevation_meters": -0.02},
    }
    weather_shift = {"sunny": 0.3, "cloudy": 0.0, "windy": 0.15, "rainy": -0.35, "stormy": -0.2}
    intercepts = {"high": -2.5, "low": 0.9, "moderate": -0.4}
    weights = []
    for k, c in enumerate(classes):
        row = [by_name[c].get(n, 0.0) for n in pre.numeric]
        sign = {"high": 1.0, "low": -1.0, "moderate": 0.5}[c]
        row += [round(sign * weather_shift[v], 4) for v in pre.vocab["weather_condition"]]
        row += [round(sign * 0.01 * ((i % 5) - 2), 4) for i in range(len(pre.vocab["state_province"]))]
        weights.append(row)
    return LinearModel(classes, pre, weights, [intercepts[c] for c in classes],
                       name="fixed_risk_model")
